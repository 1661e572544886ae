"""Bootstrap gate (E5): a sensor is evaluated once it has shown enough batches.

The counter goes up whenever a reading's batch differs from the last known one, so
A, B, A counts three. It never falls, hence the gate opens once per sensor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.operators.slices import KEY, MS, SAMPLE_ORDER, SLICE, SLICE_KEYS, dealt, keyed, with_slices

OPENS_AT = "gate_opens_at"


def batch_changes(readings: DataFrame, min_batches: int, slice_ms: int, count: int | None = None) -> DataFrame:
    """One row per (sensor, slice) with the position at which the sensor's gate opens."""
    sliced = with_slices(keyed(readings), slice_ms)
    return gate_openings(sliced if count is None else dealt(sliced, count), min_batches, SAMPLE_ORDER)


def gate_openings(sliced: DataFrame, min_batches: int, order: list[str]) -> DataFrame:
    """The opening of each sensor's gate in some order of its readings, for each of its slices in that order.

    Each slice is first cut down to its batch changes, of which no more than
    ``min_batches + 1`` can matter. Only those meet in one task per sensor.
    """
    rows = sliced.select(*SLICE_KEYS, *order, "batch_id")
    inside = Window.partitionBy(*SLICE_KEYS).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    known = F.last("batch_id", ignorenulls=True)
    differs = F.col("batch_id").isNotNull() & ~F.col("batch_id").eqNullSafe(F.col("known"))
    candidates = (
        rows.withColumn("known", known.over(so_far))
        .withColumn("changes", differs.cast("int"))
        .withColumn("position", F.row_number().over(inside))
        .withColumn(
            "ordinal",
            F.sum("changes").over(
                inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .filter(
            (F.col("position") == 1)
            | ((F.col("changes") == 1) & (F.col("ordinal") <= min_batches + 1))
        )
    )
    sensor = Window.partitionBy(KEY)
    history = sensor.orderBy(*order)
    counted = (
        candidates.withColumn(
            "known", known.over(history.rowsBetween(Window.unboundedPreceding, -1))
        )
        .withColumn(
            "total",
            F.sum(differs.cast("int")).over(
                history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
        .withColumn(
            OPENS_AT,
            F.min(F.when(F.col("total") >= min_batches, F.struct(*order))).over(sensor),
        )
    )
    return counted.filter((F.col("position") == 1) & F.col(OPENS_AT).isNotNull()).select(
        *SLICE_KEYS, OPENS_AT
    )


def gated(
    rows: DataFrame, readings: DataFrame, min_batches: int, slice_ms: int, count: int | None = None
) -> DataFrame:
    """Add ``gate_open`` to sliced rows; the rows keep their partitioning.

    ``count`` is the number of readings, where it is known.
    """
    if min_batches <= 0:
        return rows.withColumn("gate_open", F.lit(True))
    openings = batch_changes(readings, min_batches, slice_ms, count)
    reached = F.struct(*SAMPLE_ORDER) >= F.col(OPENS_AT)
    return (
        rows.join(openings, SLICE_KEYS, "left")
        .withColumn("gate_open", F.coalesce(reached, F.lit(False)))
        .drop(OPENS_AT)
    )


def batch_counts(readings: DataFrame, slice_ms: int) -> DataFrame:
    """E5 as a running figure: every reading with its sensor's ``batch_count`` so far.

    Slices are counted on their own, then shifted by what earlier slices reached. Per
    sensor only one summary row per slice meets in one task.
    """
    rows = with_slices(keyed(readings), slice_ms)
    inside = Window.partitionBy(*SLICE_KEYS).orderBy(*SAMPLE_ORDER)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.last("batch_id", ignorenulls=True)
    local = rows.withColumn("known", known.over(so_far)).withColumn(
        "inner_change",
        (
            F.col("known").isNotNull()
            & F.col("batch_id").isNotNull()
            & (F.col("batch_id") != F.col("known"))
        ).cast("int"),
    )
    local = local.withColumns(
        {
            "inner_count": F.sum("inner_change").over(upto),
            "opening_batch": F.first("batch_id", ignorenulls=True).over(upto),
        }
    )
    order = F.struct(*SAMPLE_ORDER)
    summary = rows.withColumn("known", known.over(so_far)).groupBy(*SLICE_KEYS).agg(
        F.count_if(
            F.col("known").isNotNull()
            & F.col("batch_id").isNotNull()
            & (F.col("batch_id") != F.col("known"))
        ).alias("changes"),
        F.min_by("batch_id", F.when(F.col("batch_id").isNotNull(), order)).alias("opening"),
        F.max_by("batch_id", F.when(F.col("batch_id").isNotNull(), order)).alias("closing"),
    )
    earlier = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    joins = F.col("opening").isNotNull() & ~F.col("opening").eqNullSafe(F.col("carried"))
    carried = (
        summary.withColumn("carried", F.last("closing", ignorenulls=True).over(earlier))
        .withColumn("own", F.col("changes") + joins.cast("int"))
        .withColumn("before", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
        .select(*SLICE_KEYS, "before", "carried")
    )
    starts = F.col("opening_batch").isNotNull() & ~F.col("opening_batch").eqNullSafe(
        F.col("carried")
    )
    return (
        local.join(carried, SLICE_KEYS)
        .withColumn(
            "batch_count",
            (F.col("before") + F.col("inner_count") + starts.cast("int")).cast("int"),
        )
        .drop(
            "known", "inner_change", "inner_count", "opening_batch", "before", "carried",
            *SLICE_KEYS, MS,
        )
    )
