"""Windows that hold more samples of a sensor than one task should."""

from __future__ import annotations

from helpers import frame, reading
from pyspark.sql import functions as F

from kilnwatch.operators.trailing import trailing_samples

HALF_HOUR = 1_800_000


def test_one_window_is_spread(spark):
    """A task's share of a sensor does not grow with what a window of it holds."""
    start, count = 1_700_000_000_000 // HALF_HOUR * HALF_HOUR, 18_000
    rows = spark.range(count).select(
        F.timestamp_millis(F.lit(start) + F.col("id") * 100).alias("measured_at"), F.col("id").alias("arrival_seq")
    )
    readings = rows.crossJoin(F.broadcast(frame(spark, [reading()]).drop("measured_at", "arrival_seq")))
    found = trailing_samples(readings, HALF_HOUR, HALF_HOUR)
    seen = found.select("arrival_seq", "sample_count", F.spark_partition_id().alias("task")).collect()
    assert all(row["sample_count"] == row["arrival_seq"] + 1 for row in seen)
    sizes = [sum(row["task"] == task for row in seen) for task in {row["task"] for row in seen}]
    assert sum(sizes) == count
    assert max(sizes) < 0.7 * count
