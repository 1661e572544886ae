"""Partitioned Parquet storage of readings (K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.functions.keys import sanitize_token
from kilnwatch.functions.time import utc_date
from kilnwatch.operators.projections import storage_rows

PARTITIONS = ["year", "month", "day", "device"]


def partitioned_rows(readings: DataFrame) -> DataFrame:
    """The stored columns and their partition: UTC creation day and safe device id."""
    day = utc_date(F.col("created_at"))
    return storage_rows(
        readings,
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
        sanitize_token(F.col("device_id")).alias("device"),
    )


def write_storage(readings: DataFrame, path: str, mode: str = "append") -> None:
    """Write a batch of readings.

    Rebalancing gives each partition few files of an even size: small partitions share a
    task, a large one is split over several.
    """
    rows = partitioned_rows(readings).hint("rebalance", *PARTITIONS)
    rows.write.mode(mode).option("compression", "snappy").partitionBy(*PARTITIONS).parquet(path)
