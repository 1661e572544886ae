"""Keys, paths, documents, storage columns and envelopes."""

from __future__ import annotations

import json
import re

import pytest
from helpers import frame, instant, reading
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from kilnwatch.functions.keys import (
    bucket_path,
    dedup_key,
    document_id,
    idempotency_key,
    sanitize_token,
    stream_key,
)
from kilnwatch.functions.time import iso_instant
from kilnwatch.operators.envelope import envelope_json
from kilnwatch.operators.projections import documents, reading_events, storage_rows, violation_payload
from kilnwatch.schemas import VIOLATION


def test_reading_keys(spark):
    rows = frame(
        spark,
        [
            reading(arrival_seq=0, batch_id="B1", sequence=3, sensor_id="S7"),
            reading(
                arrival_seq=1, batch_id=None, equipment_id=None, sequence=0, sensor_id=None,
                measured_at=instant(7),
            ),
            reading(arrival_seq=2, sequence=None),
        ],
    ).orderBy("arrival_seq")
    keys = rows.select(dedup_key().alias("d"), document_id().alias("i"), stream_key().alias("s"))
    assert [tuple(r) for r in keys.collect()] == [
        ("B1|1|3|S7", "1_S7_2000", "1:S7"),
        ("||0|", "__7", "null:null"),
        ("B|1|null|S1", "1_S1_2000", "1:S1"),
    ]


@pytest.mark.parametrize(
    "raw, token",
    [
        ("EQP-001", "EQP-001"), ("../../etc/passwd", ".._.._etc_passwd"), ("a/b\\c", "a_b_c"),
        (None, "unknown"), ("", "unknown"), (" \t\n", "unknown"), (" ", "unknown"),
        (".", "unknown"), ("..", "unknown"), (" ", "_"), ("기기", "__"), ("a.b", "a.b"),
    ],
)
def test_device_token(spark, raw, token):
    row = spark.createDataFrame([(raw,)], "raw string").select(sanitize_token(F.col("raw")))
    assert row.first()[0] == token


def test_bucket_path_uses_the_utc_day(spark):
    at = "2026-06-13T23:30:05Z"
    rows = spark.createDataFrame([(at,)], "at string").select(F.col("at").cast("timestamp").alias("at"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "Asia/Seoul", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            made = rows.select(bucket_path(F.col("at"), F.lit("EQP-001")), iso_instant(F.col("at")))
            assert tuple(made.first()) == ("2026/06/13/EQP-001", at)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_instant_texts(spark):
    rows = spark.createDataFrame(
        [(0,), (123_000,), (123_456,), (-1000,), (None,)], "micros long"
    ).select(iso_instant(F.timestamp_micros("micros")))
    assert [r[0] for r in rows.collect()] == [
        "1970-01-01T00:00:00Z", "1970-01-01T00:00:00.123Z", "1970-01-01T00:00:00.123456Z",
        "1969-12-31T23:59:59.999Z", None,
    ]


def test_projections(spark):
    rows = frame(spark, [reading(sensor_status="S", measurement_status="M", unit=None)])
    document = documents(rows).first().asDict()
    assert document == {
        "document_id": "1_S1_2000", "batchId": "B", "deviceId": "D", "equipmentId": 1,
        "createdAt": 1000, "intervalSec": 5, "sequence": 2, "measuredAt": 2000, "status": "S",
        "sensorId": "S1", "sensorType": "TEMP", "value": 21.5, "recipeMin": 10.0,
        "recipeMax": 30.0, "unit": None,
    }
    stored = storage_rows(rows)
    assert len(stored.columns) == 15 and stored.first()["sensorStatus"] == "S"
    assert isinstance(stored.schema["measuredAt"].dataType, TimestampType)
    assert reading_events(rows).columns[:8] == [
        "batch_id", "equipment_id", "sensor_id", "sensor_type", "value", "recipe_min",
        "recipe_max", "measured_at",
    ]


def violation(spark, **given):
    row = dict.fromkeys(VIOLATION.fieldNames()) | {
        "equipment_id": 1, "sensor_id": "TEMP_01", "sensor_type": "TEMP",
        "rule_name": "NELSON_RULE_1", "anomaly_type": "HIGH", "severity": "CRITICAL",
        "measured_value": 35.0, "reference_value": 30.0, "sample_count": 3,
        "detected_at": instant(1781396126000), "window_start": instant(1781396000500),
        "window_end": instant(1781396126000),
    } | given
    return spark.createDataFrame([tuple(row[n] for n in VIOLATION.fieldNames())], VIOLATION)


def test_envelope(spark):
    text = envelope_json(violation(spark)).first().value
    envelope = json.loads(text)
    assert list(envelope) == [
        "idempotencyKey", "eventType", "envelopeType", "aggregateType", "aggregateId",
        "traceId", "timestamp", "payload",
    ]
    assert envelope["idempotencyKey"] == "1:TEMP:CRITICAL:1781396126000"
    assert (envelope["eventType"], envelope["envelopeType"]) == ("SensorViolation", "domain")
    assert (envelope["aggregateType"], envelope["aggregateId"]) == ("Equipment", "1")
    assert re.fullmatch(r"[0-9a-f-]{36}", envelope["traceId"])
    payload = envelope["payload"]
    assert payload["detectedAt"] == "2026-06-14T00:15:26Z"
    assert payload["windowStart"] == "2026-06-14T00:13:20.500Z"
    assert payload["measuredValue"] == 35.0 and payload["deviation"] is None
    assert len(payload) == 17 == len(violation_payload(violation(spark)).columns)


def test_envelope_without_severity(spark):
    envelope = json.loads(envelope_json(violation(spark, severity=None, equipment_id=None)).first().value)
    assert envelope["idempotencyKey"] == "null:TEMP:RECOVERY:1781396126000"
    assert envelope["payload"]["severity"] is None and envelope["aggregateId"] == "null"


def test_envelope_needs_a_time(spark):
    with pytest.raises(Exception, match="no time of detection"):
        envelope_json(violation(spark, detected_at=None)).collect()


def test_full_key_tells_rules_apart(spark):
    rows = violation(spark).union(violation(spark, rule_name="BIAS_RATIO_RULE"))
    assert rows.select(idempotency_key()).distinct().count() == 1
    assert rows.select(idempotency_key("full")).distinct().count() == 2
    with pytest.raises(ValueError):
        idempotency_key("other")
