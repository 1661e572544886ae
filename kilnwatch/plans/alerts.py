"""Readings to evaluations, alerts and envelopes in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.functions.reasons import reason
from kilnwatch.operators.rules import SEVERITIES, one_row_per_rule, rule_results
from kilnwatch.operators.slices import ARRIVAL_ORDER, SAMPLE_ORDER, SLICE_KEYS
from kilnwatch.operators.transitions import CHANGES, CLOSES, OPENS, settle_slice_edges, slice_marks
from kilnwatch.options import RuleOptions
from kilnwatch.schemas import ARRIVAL, VIOLATION


def _violations(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", reason()).select(*VIOLATION.fieldNames(), *ARRIVAL)


def evaluations(
    readings: DataFrame, options: RuleOptions = RuleOptions(), rules: tuple[str, ...] = tuple(SEVERITIES)
) -> DataFrame:
    """Every evaluation of the named rules, normal ones included."""
    results = rule_results(readings, options)
    return _violations(one_row_per_rule(results, lambda rule: F.lit(rule in rules)))


def alerts(readings: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """The evaluations that changed a rule's severity.

    Severities are compared on the row of the reading, before rule rows and their texts
    are built, so only alerts and slice edges are shuffled a second time.
    """
    results = rule_results(readings, options)
    by = ARRIVAL_ORDER if options.in_arrival_order else SAMPLE_ORDER
    order = Window.partitionBy(*SLICE_KEYS).orderBy(*by)
    names = {
        rule: {mark: f"{column}_{mark}" for mark in (OPENS, CLOSES, CHANGES)}
        for rule, column in SEVERITIES.items()
    }
    marked = results.withColumns(
        {
            names[rule][mark]: flag
            for rule, column in SEVERITIES.items()
            for mark, flag in slice_marks(F.col(column), order).items()
        }
    )

    def marks(rule):
        return {mark: F.col(column) for mark, column in names[rule].items()}

    def wanted(rule):
        opens, closes, changes = marks(rule).values()
        return opens | closes | changes

    return _violations(settle_slice_edges(one_row_per_rule(marked, wanted, marks), by))
