"""The three rules over trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch import schemas as S
from kilnwatch.functions.compare import above, at_least, below, is_true
from kilnwatch.operators.arrival import LIMIT, SIGMA_OF_RANGE, TREND, set_figures
from kilnwatch.operators.gate import gated
from kilnwatch.operators.slices import KEY, SAMPLE_ORDER, SLICE, SLICE_KEYS, dealt
from kilnwatch.operators.trailing import Tally, spread, stretched_samples, sweep
from kilnwatch.options import RuleOptions
from kilnwatch.session import written

# Fixed values of the rules.
CRITICAL_BREACHES = 3
TREND_SHARE = 0.7
TREND_CHANGE_PERCENT = 5.0
NEAR_LIMIT_SHARE = 0.9
BIAS_SHARE = 0.8

SEVERITIES = {S.RULE_1: "limit_severity", S.BIAS: "bias_severity", S.RULE_3: "trend_severity"}


def _flag(condition: Column) -> Column:
    return is_true(condition).cast("int")


def _breach(low: Column, high: Column) -> Column:
    value = F.col("value")
    return is_true(above(low, value)) | is_true(above(value, high))


def _ratio(part: str, whole: str) -> Column:
    return F.col(part).cast("double") / F.when(F.col(whole) > 0, F.col(whole).cast("double"))


def _choose(code: str, values: dict[int, Column]) -> Column:
    """The value belonging to a code, NULL for any other code."""
    chosen = None
    for number, value in values.items():
        hit = F.col(code) == number
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen


def limit_severity() -> Column:
    """three or more samples outside the limits are critical, fewer are a caution."""
    breaches = F.col("breaches")
    return (
        F.when(breaches == 0, F.lit(S.NORMAL))
        .when(breaches >= CRITICAL_BREACHES, F.lit(S.CRITICAL))
        .otherwise(F.lit(S.CAUTION))
    )


def trend_direction(min_samples: int) -> Column:
    """1 or -1 where most steps go one way and the net change is large enough."""
    first, last = F.col("trend_first.value"), F.col("value")
    change = F.abs((last - first) / F.when(first != 0.0, first)) * 100.0
    moved = (F.col("trend_count") >= min_samples) & ~(change < TREND_CHANGE_PERCENT)
    return (
        F.when(~is_true(moved), F.lit(0))
        .when(_ratio("rises", "steps") >= TREND_SHARE, F.lit(1))
        .when(_ratio("falls", "steps") >= TREND_SHARE, F.lit(-1))
        .otherwise(F.lit(0))
    )


def trend_severity(low: Column, high: Column) -> Column:
    """critical when the last value is close to the limit it moves to."""
    span, last = high - low, F.col("value")
    run = F.when(F.col("trend_direction") == 1, last - low).otherwise(high - last)
    near = at_least(run / F.when(~(span <= 0.0), span), F.lit(NEAR_LIMIT_SHARE))
    return (
        F.when(F.col("trend_direction") == 0, F.lit(S.NORMAL))
        .when(is_true(near), F.lit(S.CRITICAL))
        .otherwise(F.lit(S.CAUTION))
    )


def bias_thresholds(low: Column, high: Column) -> dict[str, Column]:
    """Limits of the one- and two-sigma bands around the middle of the range."""
    mean = (low + high) / 2.0
    sigma = (high - low) * SIGMA_OF_RANGE
    return {
        "far_above": mean + sigma * 2,
        "far_below": mean - sigma * 2,
        "some_above": mean + sigma,
        "some_below": mean - sigma,
    }


# Codes of the bias outcomes, in the order they are tried; zero is none.
BIAS_CODES = {"far_above": 1, "far_below": 2, "some_above": 3, "some_below": 4}


def bias_code(low: Column, high: Column, min_samples: int) -> Column:
    """eight of ten values on one side, beyond two sigma or beyond one."""
    usable = (F.col("limit_count") >= min_samples) & ~(high <= low)
    code = F.when(~is_true(usable), F.lit(0))
    for name, number in BIAS_CODES.items():
        code = code.when(_ratio(name, "valued") >= BIAS_SHARE, F.lit(number))
    return code.otherwise(F.lit(0))


def bias_severity() -> Column:
    return (
        F.when(F.col("bias_code") == 0, F.lit(S.NORMAL))
        .when(F.col("bias_code") <= 2, F.lit(S.CRITICAL))
        .otherwise(F.lit(S.CAUTION))
    )


def with_limit_sets(samples: DataFrame, window_ms: int, stretch_ms: int, count: int) -> DataFrame:
    """Repeat a sample once per pair of limits that a reading able to see it may use.

    Samples are judged by the limits of the reading that looks at them, so a pair needs the
    samples of the last window only. Time is cut into spans of a window, rounded up to whole
    stretches: a sample is copied to the pairs used in its own span and the next. Nearly
    always that is one pair, and one change of limits costs two spans. ``own_limits`` marks
    the copy that stands for the reading itself.
    """
    limits = F.struct("recipe_min", "recipe_max")
    span_ms = stretch_ms * max(1, -(-window_ms // stretch_ms))
    used = samples.select(
        *SLICE_KEYS, F.floor(F.col(SLICE) / F.lit(span_ms)).alias("_span"), limits.alias("_limits")
    ).distinct()
    used = written(used, "limits")
    in_reach = F.explode(F.array(F.col("_span"), F.col("_span") - 1)).alias("_span")
    sets = used.select(KEY, "_limits", in_reach).groupBy(KEY, "_span").agg(F.collect_set("_limits").alias("_sets"))
    found = used.select(*SLICE_KEYS, "_span").distinct().join(sets, [KEY, "_span"]).drop("_span")
    return (
        dealt(samples, count).join(found, SLICE_KEYS)
        .select("*", F.explode("_sets").alias("set_limits"))
        .withColumn("own_limits", F.col("set_limits").eqNullSafe(limits))
        .drop("_sets")
    )


def _tallies(low: Column, high: Column) -> dict[str, Tally]:
    value = F.col("value")
    thresholds = bias_thresholds(low, high)
    sides = {
        name: above(value, limit) if name.endswith("above") else below(value, limit)
        for name, limit in thresholds.items()
    }
    before, after = F.col("previous_value"), F.col("next_value")

    def steps(test) -> Tally:
        # A step belongs to both its samples: it comes with the later, goes with the earlier.
        return Tally(TREND, _flag(test(before, value)), _flag(test(value, after)))

    return {
        "breaches": Tally(LIMIT, _breach(low, high).cast("int")),
        "valued": Tally(LIMIT, _flag(value.isNotNull())),
        **{name: Tally(LIMIT, _flag(side)) for name, side in sides.items()},
        "rises": steps(lambda earlier, later: above(later, earlier)),
        "falls": steps(lambda earlier, later: below(later, earlier)),
        "steps": steps(lambda earlier, later: earlier.isNotNull() & later.isNotNull()),
    }


def rule_results(readings: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """One row per reading with the result of each rule.

    The rules share one shuffle of the samples; the gate reads the batches a second time.
    With ``options.in_arrival_order`` or ``options.own_limits`` the sample sets are worked
    out by :mod:`kilnwatch.operators.arrival` instead of running sums.

    ``limit_result`` and ``bias_result`` are NULL while the sensor's gate is closed.
    """
    if options.in_arrival_order or options.own_limits:
        return _judged(set_figures(readings, options), options)
    stretch_ms, count = spread(readings, options.slice_length_ms)
    # Neighbours are those of the same pair: what a reading sees of its pair has no gaps.
    samples = with_limit_sets(stretched_samples(readings, stretch_ms), options.longest_window_ms, stretch_ms, count)
    low, high = F.col("set_limits.recipe_min"), F.col("set_limits.recipe_max")
    swept = sweep(
        samples,
        {LIMIT: options.limit_window_ms, TREND: options.trend_window_ms},
        _tallies(low, high),
        stretch_ms,
        latest={"latest_breach": F.when(_breach(low, high), F.col("value"))},
        within=("set_limits",),
    ).filter("own_limits")
    return _judged(gated(swept, readings, options.min_batches, stretch_ms, count), options).drop(
        "set_limits", "own_limits", "batch_id"
    )


def _judged(figures: DataFrame, options: RuleOptions) -> DataFrame:
    """The rules' severities from the figures of the sample sets."""
    low, high = F.col("recipe_min"), F.col("recipe_max")
    open_gate = F.col("gate_open")
    return (
        figures.withColumns(
            {
                "bias_code": bias_code(low, high, options.min_bias_samples),
                "trend_direction": trend_direction(options.min_trend_samples),
            }
        )
        .withColumns(
            {
                SEVERITIES[S.RULE_1]: F.when(open_gate, limit_severity()),
                SEVERITIES[S.BIAS]: F.when(open_gate, bias_severity()),
                SEVERITIES[S.RULE_3]: trend_severity(low, high),
            }
        )
        .drop("gate_open")
    )


def one_row_per_rule(results: DataFrame, wanted=None, marks=None) -> DataFrame:
    """Rule results as rows, all rules together.

    ``wanted(rule)`` may narrow the rows of a rule and ``marks(rule)`` add flags to them,
    before any figure is worked out for the rest.
    """
    rows = []
    for rule, severity in SEVERITIES.items():
        keep = F.col(severity).isNotNull()
        if wanted is not None:
            keep = keep & wanted(rule)
        flags = [] if marks is None else [f.alias(n) for n, f in marks(rule).items()]
        row = F.struct(
            F.lit(rule).alias("rule_name"), F.col(severity).alias("severity"), *flags
        )
        rows.append(F.when(keep, row))
    kept = results.withColumn("_row", F.explode(F.array_compact(F.array(*rows)))).select(
        "*", "_row.*"
    )
    flags = [] if marks is None else list(marks(S.RULE_1))
    return with_figures(kept).select(
        *SLICE_KEYS,
        *SAMPLE_ORDER,
        "equipment_id",
        "sensor_id",
        "sensor_type",
        "rule_name",
        "anomaly_type",
        "severity",
        "measured_value",
        "reference_value",
        "deviation",
        "deviation_rate",
        "min",
        "max",
        F.col("measured_at").alias("detected_at"),
        "window_start",
        F.col("measured_at").alias("window_end"),
        "sample_count",
        "evidence",
        *flags,
    )


def with_figures(rows: DataFrame) -> DataFrame:
    """The figures behind each evaluation; all NULL where it is normal."""
    low, high = F.col("recipe_min"), F.col("recipe_max")
    detected = F.col("severity") != S.NORMAL
    rule = F.col("rule_name")
    start = F.when(rule == S.RULE_3, F.col("trend_first.ms")).otherwise(F.col("limit_first.ms"))
    count = F.when(rule == S.RULE_3, F.col("trend_count")).otherwise(F.col("limit_count"))
    over = is_true(above(F.col("latest_breach"), high))
    # One code for what was found: bias 1 to 4, limits 5 and 6, trends 7 and 8.
    found = (
        F.when(~detected, F.lit(0))
        .when(rule == S.BIAS, F.col("bias_code"))
        .when(rule == S.RULE_1, F.when(over, F.lit(5)).otherwise(F.lit(6)))
        .when(F.col("trend_direction") == 1, F.lit(7))
        .otherwise(F.lit(8))
    )
    kinds = [
        S.BIAS_UP, S.BIAS_DOWN, S.BIAS_UP, S.BIAS_DOWN, S.HIGH, S.LOW, S.TREND_UP, S.TREND_DOWN,
    ]
    thresholds = bias_thresholds(low, high)
    references = {number: thresholds[name] for name, number in BIAS_CODES.items()}
    references |= {5: high, 6: low, 7: high, 8: low}
    shares = {n: F.col(name).cast("double") / F.col("valued") for name, n in BIAS_CODES.items()}
    code = F.col("found")
    first, measured, reference = (
        F.col("trend_first.value"), F.col("measured_value"), F.col("reference_value"),
    )
    of_reference = F.col("deviation") / F.when(reference != 0.0, reference) * 100.0
    return (
        rows.withColumns(
            {
                "found": found,
                "window_start": F.timestamp_millis(start),
                "sample_count": count.cast("int"),
            }
        )
        .withColumns(
            {
                "anomaly_type": F.when(
                    code > 0, F.element_at(F.array(*map(F.lit, kinds)), F.greatest(code, F.lit(1)))
                ),
                "measured_value": F.when(code.isin(5, 6), F.col("latest_breach")).when(
                    code > 0, F.col("value")
                ),
                "reference_value": _choose("found", references),
                "min": F.when(detected, low),
                "max": F.when(detected, high),
                "evidence": _choose(
                    "found",
                    {
                        5: F.col("breaches").cast("double"),
                        6: F.col("breaches").cast("double"),
                        7: _ratio("rises", "steps"),
                        8: _ratio("falls", "steps"),
                        **shares,
                    },
                ),
            }
        )
        .withColumn(
            "deviation",
            F.when(code >= 7, F.abs(measured - first)).otherwise(F.abs(measured - reference)),
        )
        .withColumn(
            "deviation_rate",
            F.when(code.between(1, 4), F.col("evidence") * 100.0)
            .when(code >= 7, F.abs((measured - first) / F.when(first != 0.0, first)) * 100.0)
            .when(code >= 5, F.coalesce(of_reference, F.lit(0.0))),
        )
    )
