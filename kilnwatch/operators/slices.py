"""Time slices: how one sensor's history is spread over many tasks.

A sensor may hold a third of all readings, so no step may put a whole sensor into one
task. Work is partitioned by (sensor, slice) instead. A reading whose trailing window
reaches back past the start of its slice finds those earlier readings as lead-in copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.functions.keys import stream_key
from kilnwatch.schemas import ARRIVAL

KEY, SLICE, LEAD_IN, MS = "stream_key", "slice_start", "lead_in", "ms"
SLICE_KEYS = [KEY, SLICE]
SAMPLE_ORDER = [MS, *ARRIVAL]
ARRIVAL_ORDER = [*ARRIVAL, MS]
#: Samples a task holds on average, where more partitions than the session's are needed for that.
SAMPLES_A_TASK = 1 << 17


def keyed(readings: DataFrame) -> DataFrame:
    """Add the sensor key and the event time in milliseconds."""
    return readings.withColumns(
        {KEY: stream_key(), MS: F.unix_millis("measured_at")}
    )


def slice_of(ms, slice_ms: int):
    """Start of the slice an instant falls into."""
    return ms - F.pmod(ms, F.lit(slice_ms))


def dealt(rows: DataFrame, samples: int) -> DataFrame:
    """Rows by sensor and slice, in partitions whose number grows with the ``samples`` behind them.

    There are as many as the session has for shuffles, or more. The number is given as Spark would
    else merge partitions by their packed size, and these rows take many times that when they are sorted.
    """
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(usual, -(-samples // SAMPLES_A_TASK)), *SLICE_KEYS)


def with_slices(rows: DataFrame, slice_ms: int, window_ms: int | None = None) -> DataFrame:
    """Add the slice. With ``window_ms``, also copy rows the next slice looks back to.

    The slice is at least as long as the window, so a row gets one copy at most.
    """
    own = slice_of(F.col(MS), slice_ms)
    return _spread(rows, own, slice_ms, window_ms)


def with_arrival_slices(rows: DataFrame, peak: str, slice_ms: int, window_ms: int) -> DataFrame:
    """The same by ``peak``, the latest time of the sensor up to a row's arrival.

    It never falls, so slices hold consecutive arrivals. What a slice still sees of earlier
    ones lies within a window of its start, all of it in the slice just before.
    """
    return _spread(rows, slice_of(F.col(peak), slice_ms), slice_ms, window_ms)


def _spread(rows: DataFrame, own, slice_ms: int, window_ms: int | None) -> DataFrame:
    if window_ms is None:
        return rows.withColumn(SLICE, own)
    if slice_ms < window_ms:
        raise ValueError("a time slice cannot be shorter than its window")
    following = own + F.lit(slice_ms)
    seen_later = F.col(MS) >= following - F.lit(window_ms)
    targets = F.when(seen_later, F.array(own, following)).otherwise(F.array(own))
    return rows.withColumn("_own", own).withColumn(SLICE, F.explode(targets)).withColumn(
        LEAD_IN, F.col(SLICE) > F.col("_own")
    ).drop("_own")
