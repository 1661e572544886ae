"""Sample sets in order of arrival, and with limits of each reading's own.

Readings are dealt by sensor and slice, with the samples a slice still sees of the one before, like in the other plans;
inside a slice, numpy works out the figures of all sets (:mod:`kilnwatch.operators.sample_sets`). In order of arrival a
slice is a stretch of arrivals: it begins when the sensor's latest time enters a new slice of time. That running maximum
is taken in two steps, so that no sensor is gathered: inside stretches of arrival numbers, and over one row for each.

A task holds one sensor's slice in memory; a shorter ``slice_ms`` makes it smaller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kilnwatch.operators.gate import OPENS_AT, gate_openings, gated
from kilnwatch.operators.projections import reading_events
from kilnwatch.operators.sample_sets import Samples, limit_figures, trailing
from kilnwatch.operators.slices import (
    ARRIVAL_ORDER,
    KEY,
    LEAD_IN,
    MS,
    SAMPLE_ORDER,
    SLICE,
    SLICE_KEYS,
    keyed,
    with_arrival_slices,
)
from kilnwatch.operators.trailing import sliced_samples
from kilnwatch.options import RuleOptions

# Fixed value of the rules.
SIGMA_OF_RANGE = 0.167

LIMIT, TREND = "limit", "trend"
STRETCH, PEAK, LATE_MS = "arrival_stretch", "peak_ms", "late_ms"
#: Rows worked on at once, unless one sensor's slice has more.
ROWS_AT_ONCE = 1 << 15

COUNTS = ["valued", "breaches", "far_above", "far_below", "some_above", "some_below"]
STEPS = ["rises", "falls", "steps"]


def with_peaks(readings: DataFrame, options: RuleOptions) -> DataFrame:
    """Reading events with their sensor's latest time so far, by arrival, and whether its gate is open."""
    stretch = F.expr(f"arrival_seq div {options.slice_arrivals}")
    rows = keyed(reading_events(readings)).withColumn(STRETCH, stretch)
    earlier = Window.partitionBy(KEY).orderBy(STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    known = (
        rows.groupBy(KEY, STRETCH)
        .agg(F.max(MS).alias("own_peak"))
        .withColumn("peak_before", F.max("own_peak").over(earlier))
        .drop("own_peak")
    )
    if options.min_batches > 0:
        openings = gate_openings(rows.withColumn(SLICE, F.col(STRETCH)), options.min_batches, ARRIVAL_ORDER)
        known = known.join(openings.withColumnRenamed(SLICE, STRETCH), [KEY, STRETCH], "left")
        is_open = F.coalesce(F.struct(*ARRIVAL_ORDER) >= F.col(OPENS_AT), F.lit(False))
    else:
        known, is_open = known.withColumn(OPENS_AT, F.lit(None)), F.lit(True)
    so_far = Window.partitionBy(KEY, STRETCH).orderBy(*ARRIVAL_ORDER)
    return (
        rows.join(known, [KEY, STRETCH])
        .withColumn(PEAK, F.greatest("peak_before", F.max(MS).over(so_far.rowsBetween(Window.unboundedPreceding, 0))))
        .withColumn("gate_open", is_open)
        .withColumn(LATE_MS, F.col(PEAK) - F.col(MS))
        .drop("peak_before", OPENS_AT, STRETCH, "batch_id")
    )


def late_readings(readings: DataFrame, options: RuleOptions = RuleOptions()) -> DataFrame:
    """For each sensor its readings, how many came after a later one, after more than a window, and by how much at most."""
    ungated = RuleOptions(min_batches=0, slice_arrivals=options.slice_arrivals)
    rows = with_peaks(readings, ungated)
    return rows.groupBy("equipment_id", "sensor_id").agg(
        F.count("*").alias("readings"),
        F.count_if(F.col(LATE_MS) > 0).alias("late"),
        F.count_if(F.col(LATE_MS) > options.longest_window_ms).alias("beyond_window"),
        F.max(LATE_MS).alias("latest_by_ms"),
    )


def set_figures(readings: DataFrame, options: RuleOptions) -> DataFrame:
    """Each reading with the figures of its two sets, the set's last value as ``value``, and its gate."""
    window, slice_ms = options.longest_window_ms, options.slice_length_ms
    if options.in_arrival_order:
        order = ARRIVAL_ORDER
        sliced = with_arrival_slices(with_peaks(readings, options), PEAK, slice_ms, window).drop(PEAK, LATE_MS)
    else:
        order = SAMPLE_ORDER
        sliced = sliced_samples(readings, window, slice_ms).drop("batch_id")
    dealt = sliced.repartition(*SLICE_KEYS).sortWithinPartitions(*SLICE_KEYS, *order)
    figures = _figures(dealt, options)
    firsts = {
        f"{name}_first": F.struct(F.col(f"{name}_first_ms").alias("ms"), F.col(f"{name}_first_value").alias("value"))
        for name in (LIMIT, TREND)
    }
    figures = figures.withColumns(firsts)
    if options.in_arrival_order:
        return figures
    return gated(figures, readings, options.min_batches, slice_ms).drop("batch_id")


def _figures(dealt: DataFrame, options: RuleOptions) -> DataFrame:
    long, double = T.LongType(), T.DoubleType()
    added = {f"{name}_{what}": long for name in (LIMIT, TREND) for what in ("count", "first_ms")}
    added |= {f"{name}_first_value": double for name in (LIMIT, TREND)}
    added |= {name: long for name in (*COUNTS, *STEPS)} | {"latest_breach": double}
    kept = [field for field in dealt.schema if field.name != LEAD_IN]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in added.items())])
    names, passed = list(added), [field.name for field in kept]
    windows = options.limit_window_ms, options.trend_window_ms
    # Plain values and this module's functions by value: tasks need nothing installed.
    sigma, at_once, group = SIGMA_OF_RANGE, ROWS_AT_ONCE, SLICE_KEYS
    lead_in, ms_name, counts, steps = LEAD_IN, MS, COUNTS, STEPS
    limit, trend = LIMIT, TREND

    def numbers(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
        column = table.column(name).combine_chunks()
        known = pc.is_valid(column).to_numpy(zero_copy_only=False)
        return pc.fill_null(column, float("nan")).to_numpy(zero_copy_only=False), known

    def worked(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ms = table.column(ms_name).to_numpy()
        values, valued = numbers(table, "value")
        (low, _), (high, _) = numbers(table, "recipe_min"), numbers(table, "recipe_max")
        samples = Samples.of(ms, values, valued, starts, max(windows))
        limit_sets, trend_sets = (trailing(samples, window) for window in windows)
        found = {name: getattr(trend_sets, name) for name in steps}
        figures = limit_figures(samples, limit_sets, low, high, sigma)
        found |= {name: figures[name] for name in counts}
        # A breach is a number, so what is not a number here is no breach.
        found["latest_breach"] = pa.array(figures["latest_breach"], from_pandas=True)
        own = table.column("value").combine_chunks()
        for name, sets in ((limit, limit_sets), (trend, trend_sets)):
            found[f"{name}_count"] = sets.count
            found[f"{name}_first_ms"] = ms[sets.first]
            found[f"{name}_first_value"] = own.take(pa.array(sets.first))
        last = table.column("value").combine_chunks().take(pa.array(samples.last()))
        table = table.set_column(table.schema.get_field_index("value"), "value", last)
        columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in (found[name] for name in names)]
        out = pa.Table.from_arrays([*(table.column(name) for name in passed), *columns], names=[*passed, *names])
        own_rows = pc.invert(table.column(lead_in))
        for start in range(0, out.num_rows, at_once):
            yield from out.slice(start, at_once).filter(own_rows.slice(start, at_once)).combine_chunks().to_batches()

    def edges(table: pa.Table) -> np.ndarray:
        """The first row of each sensor's slice."""
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for name in group:
            column = table.column(name).combine_chunks()
            change |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(change) + 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, wanted = 0, at_once
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < wanted:
                continue
            table = pa.Table.from_batches(held)
            starts = edges(table)
            if len(starts) > 1:
                # The last slice may go on in the next batch.
                yield from worked(table.slice(0, starts[-1]), starts[:-1])
                table = table.slice(starts[-1])
            held, size = table.to_batches(), table.num_rows
            wanted = max(at_once, 2 * size)
        if size:
            table = pa.Table.from_batches(held)
            yield from worked(table, edges(table))

    return dealt.mapInArrow(run, schema)
