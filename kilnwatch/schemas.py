"""Column names and types. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Nested input, with the field names of the JSON messages. The numeric ``id`` is the
# equipment id; a string ``equipmentId`` in the message is ignored.
SENSOR = T.StructType(
    [
        T.StructField("sensorId", T.StringType()),
        T.StructField("sensorType", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("recipeMin", T.DoubleType()),
        T.StructField("recipeMax", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)
MEASUREMENT = T.StructType(
    [
        T.StructField("sequence", T.IntegerType()),
        T.StructField("measuredAt", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("sensors", T.ArrayType(SENSOR)),
    ]
)
BATCH = T.StructType(
    [
        T.StructField("batchId", T.StringType()),
        T.StructField("deviceId", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("createdAt", T.TimestampType()),
        T.StructField("intervalSec", T.IntegerType()),
        T.StructField("measurements", T.ArrayType(MEASUREMENT)),
    ]
)

# Order of arrival: the message, then the position of the reading inside the message.
ARRIVAL = ["arrival_seq", "element_seq"]

# One row per sensor reading. Timestamps hold whole milliseconds.
READING = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("equipment_id", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("interval_sec", T.IntegerType()),
        T.StructField("sequence", T.IntegerType()),
        T.StructField("measured_at", T.TimestampType()),
        T.StructField("measurement_status", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("recipe_min", T.DoubleType()),
        T.StructField("recipe_max", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("sensor_status", T.StringType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("element_seq", T.LongType()),
    ]
)

# One row per rule evaluation; alerts are the subset where the severity changed.
VIOLATION = T.StructType(
    [
        T.StructField("equipment_id", T.LongType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("measured_value", T.DoubleType()),
        T.StructField("reference_value", T.DoubleType()),
        T.StructField("deviation", T.DoubleType()),
        T.StructField("deviation_rate", T.DoubleType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("sample_count", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Fixed values of the alert contract.
NORMAL, CAUTION, CRITICAL = "NORMAL", "CAUTION", "CRITICAL"
HIGH, LOW = "HIGH", "LOW"
TREND_UP, TREND_DOWN = "TREND_UP", "TREND_DOWN"
BIAS_UP, BIAS_DOWN = "BIAS_UP", "BIAS_DOWN"
RULE_1, RULE_3, BIAS = "NELSON_RULE_1", "NELSON_RULE_3", "BIAS_RATIO_RULE"
