"""The column sets of each consumer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.functions.keys import document_id
from kilnwatch.functions.time import whole_millis
from kilnwatch.schemas import ARRIVAL

# Field names of the stored table, the document and the alert payload.
STORAGE_COLUMNS = {
    "batchId": "batch_id",
    "deviceId": "device_id",
    "equipmentId": "equipment_id",
    "createdAt": "created_at",
    "intervalSec": "interval_sec",
    "sequence": "sequence",
    "measuredAt": "measured_at",
    "measurementStatus": "measurement_status",
    "sensorId": "sensor_id",
    "sensorType": "sensor_type",
    "value": "value",
    "recipeMin": "recipe_min",
    "recipeMax": "recipe_max",
    "unit": "unit",
    "sensorStatus": "sensor_status",
}
DOCUMENT_COLUMNS = {
    "batchId": "batch_id",
    "deviceId": "device_id",
    "equipmentId": "equipment_id",
    "createdAt": "created_at",
    "intervalSec": "interval_sec",
    "sequence": "sequence",
    "measuredAt": "measured_at",
    "status": "sensor_status",
    "sensorId": "sensor_id",
    "sensorType": "sensor_type",
    "value": "value",
    "recipeMin": "recipe_min",
    "recipeMax": "recipe_max",
    "unit": "unit",
}
PAYLOAD_COLUMNS = {
    "equipmentId": "equipment_id",
    "sensorId": "sensor_id",
    "sensorType": "sensor_type",
    "ruleName": "rule_name",
    "anomalyType": "anomaly_type",
    "severity": "severity",
    "measuredValue": "measured_value",
    "referenceValue": "reference_value",
    "deviation": "deviation",
    "deviationRate": "deviation_rate",
    "min": "min",
    "max": "max",
    "detectedAt": "detected_at",
    "windowStart": "window_start",
    "windowEnd": "window_end",
    "sampleCount": "sample_count",
    "reason": "reason",
}
TIMES = {"created_at", "measured_at"}


def reading_events(readings: DataFrame) -> DataFrame:
    """What the anomaly rules need, with the order of arrival."""
    return readings.select(
        "batch_id",
        "equipment_id",
        "sensor_id",
        "sensor_type",
        "value",
        "recipe_min",
        "recipe_max",
        "measured_at",
        *ARRIVAL,
    )


def documents(readings: DataFrame, *extra: str) -> DataFrame:
    """The document id and its 14 fields, with times as epoch milliseconds."""
    fields = [
        (F.unix_millis(column) if column in TIMES else F.col(column)).alias(name)
        for name, column in DOCUMENT_COLUMNS.items()
    ]
    return readings.select(document_id().alias("document_id"), *fields, *extra)


def storage_rows(readings: DataFrame, *extra) -> DataFrame:
    """The 15 stored columns."""
    fields = [
        (whole_millis(F.col(column)) if column in TIMES else F.col(column)).alias(name)
        for name, column in STORAGE_COLUMNS.items()
    ]
    return readings.select(*fields, *extra)


def violation_payload(alerts: DataFrame, *extra) -> DataFrame:
    """The 17 payload fields."""
    return alerts.select(
        *[F.col(column).alias(name) for name, column in PAYLOAD_COLUMNS.items()], *extra
    )
