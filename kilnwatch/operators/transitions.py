"""Change-only alerting (E7): a rule's evaluation passes when its severity differs
from the one before it. The first evaluation of a rule always passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.operators.slices import KEY, MS, SAMPLE_ORDER, SLICE, slice_of
from kilnwatch.functions.keys import stream_key
from kilnwatch.schemas import ARRIVAL

OPENS, CLOSES, CHANGES = "opens_slice", "closes_slice", "changes"
# Stands for a missing severity, which equals "nothing seen yet".
NOTHING = "-"


def slice_marks(severity: Column, order) -> dict[str, Column]:
    """Whether an evaluation opens or closes its slice, or changes severity inside it.

    A NULL severity means not evaluated.
    """
    before, after = F.lag(severity).over(order), F.lead(severity).over(order)
    return {
        OPENS: severity.isNotNull() & before.isNull(),
        CLOSES: severity.isNotNull() & after.isNull(),
        CHANGES: F.coalesce(severity != before, F.lit(False)),
    }


def settle_slice_edges(rows: DataFrame, by: list[str] = SAMPLE_ORDER) -> DataFrame:
    """Decide the evaluations that open a slice by the close of the slice before.

    Changes inside a slice stay spread over slices. Per sensor and rule, only the two
    edge rows of each slice meet in one task.
    """
    edge = F.col(OPENS) | F.col(CLOSES)
    rows = rows.withColumn("_group", F.when(~edge, F.col(SLICE)))
    order = Window.partitionBy(KEY, "rule_name", "_group").orderBy(*by)
    severity = F.coalesce("severity", F.lit(NOTHING))
    before = F.coalesce(F.lag(severity).over(order), F.lit(NOTHING))
    return (
        rows.withColumn("_differs", severity != before)
        .filter(F.col(CHANGES) | (F.col(OPENS) & F.col("_differs")))
        .drop("_group", "_differs", OPENS, CLOSES, CHANGES)
    )


def transitions(evaluations: DataFrame, slice_ms: int) -> DataFrame:
    """E7 for evaluations from anywhere: violation rows with their order of arrival."""
    sliced = evaluations.withColumns(
        {KEY: stream_key(), MS: F.unix_millis("detected_at")}
    ).withColumn(SLICE, slice_of(F.col(MS), slice_ms))
    order = Window.partitionBy(KEY, "rule_name", SLICE).orderBy(*SAMPLE_ORDER)
    marked = sliced.withColumns(slice_marks(F.coalesce("severity", F.lit(NOTHING)), order))
    kept = marked.filter(F.col(OPENS) | F.col(CLOSES) | F.col(CHANGES))
    return settle_slice_edges(kept).drop(KEY, MS, SLICE)
