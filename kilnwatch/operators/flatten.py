"""Nested batches to one row per sensor reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.functions.time import whole_millis

#: The text of a message that could not be read.
POISON = "poison"


def flatten_batches(batches: DataFrame) -> DataFrame:
    """``batch, arrival_seq`` rows to readings; no shuffle.

    Missing lists and NULL elements are skipped without losing their siblings. A
    measurement without a time takes the batch's; with neither it is dropped.
    """
    return _flattened(batches)


def flatten_with_poison(messages: DataFrame) -> DataFrame:
    """The same from messages that also have ``poison``; one that is set makes a row of its own, without a reading."""
    return _flattened(messages, POISON)


def _flattened(batches: DataFrame, *poison: str) -> DataFrame:
    spoilt = F.col(POISON).isNotNull() if poison else F.lit(False)

    def elements(name: str, parent: str):
        lists = F.col(f"{parent}.{name}")
        return F.coalesce(lists, F.when(spoilt, F.array(F.lit(None)))) if poison else lists

    measurements = batches.select(
        *poison,
        F.col("arrival_seq"),
        F.col("batch.batchId").alias("batch_id"),
        F.col("batch.deviceId").alias("device_id"),
        F.col("batch.id").alias("equipment_id"),
        whole_millis(F.col("batch.createdAt")).alias("created_at"),
        F.col("batch.intervalSec").alias("interval_sec"),
        F.posexplode(elements("measurements", "batch")).alias("measurement_pos", "measurement"),
    )
    timed = measurements.filter(
        spoilt | F.coalesce("measurement.measuredAt", "created_at").isNotNull()
    )
    sensors = timed.select(
        "*", F.posexplode(elements("sensors", "measurement")).alias("sensor_pos", "sensor")
    ).filter(spoilt | F.col("sensor").isNotNull())
    epoch = F.timestamp_millis(F.lit(0))
    return sensors.select(
        "batch_id",
        "device_id",
        "equipment_id",
        F.coalesce("created_at", epoch).alias("created_at"),
        "interval_sec",
        F.col("measurement.sequence").alias("sequence"),
        F.coalesce(whole_millis(F.col("measurement.measuredAt")), "created_at").alias(
            "measured_at"
        ),
        F.col("measurement.status").alias("measurement_status"),
        F.col("sensor.sensorId").alias("sensor_id"),
        F.col("sensor.sensorType").alias("sensor_type"),
        F.col("sensor.value").alias("value"),
        F.col("sensor.recipeMin").alias("recipe_min"),
        F.col("sensor.recipeMax").alias("recipe_max"),
        F.col("sensor.unit").alias("unit"),
        F.col("sensor.status").alias("sensor_status"),
        "arrival_seq",
        (F.col("measurement_pos").cast("bigint") * 2**31 + F.col("sensor_pos")).alias(
            "element_seq"
        ),
        *poison,
    )
