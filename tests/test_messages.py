"""Parsing, poison and flattening."""

from __future__ import annotations

import json
import re

import pytest
from helpers import UTC, instant
from pyspark.sql import functions as F

from kilnwatch.operators.flatten import flatten_batches
from kilnwatch.schemas import BATCH, READING
from kilnwatch.sources.messages import (
    count_messages,
    parse_messages,
    poison_messages,
    topic_arrival,
    valid_batches,
)
from kilnwatch.streaming.jobs import readings_of

SENSOR = {
    "sensorId": "S1", "sensorType": "TEMP", "value": 21.0, "recipeMin": 10.0,
    "recipeMax": 30.0, "unit": "C", "status": "OK",
}


def message(sensor=None, measurement=None, **batch) -> str:
    parts = {
        "sequence": 0, "measuredAt": "2026-06-13T00:00:00Z", "status": "OK",
        "sensors": [SENSOR | (sensor or {})],
    }
    whole = {
        "batchId": "B1", "deviceId": "D1", "id": 1, "equipmentId": "EQP-001",
        "createdAt": "2026-06-13T00:00:00Z", "intervalSec": 5,
        "measurements": [parts | (measurement or {})],
    }
    return json.dumps(whole | batch)


CASES = [
    # name, message, the expected field or None where the message is skipped
    ("valid", message(), ("id", 1)),
    ("keys of other systems", message(plant={"line": [4, None]}, batchId="B9"), ("batchId", "B9")),
    ("text behind", message(id=4) + " and more", ("id", 4)),
    ("cut short", message()[:-5], None),
    ("empty", "", None),
    ("missing", None, None),
    ("json null", "null", None),
    ("array", "[1]", None),
    ("number", "5", None),
    ("bad double", message({"value": "abc"}), None),
    ("double in quotes", message({"value": "1.5"}), ("value", 1.5)),
    ("special double", message({"value": "Infinity"}), ("value", float("inf"))),
    ("whole as double", message({"value": 3}), ("value", 3.0)),
    ("empty double", message({"value": ""}), ("value", None)),
    ("long in quotes", message(id="12"), ("id", 12)),
    ("fraction in quotes as long", message(id="1x2"), None),
    ("fraction as int", message(intervalSec=5.7), ("intervalSec", 5)),
    ("int too large", message(intervalSec=3_000_000_000), None),
    ("number as text", message(batchId=7), ("batchId", "7")),
    ("epoch seconds", message(createdAt=1749772800), ("createdAt", 1749772800000)),
    ("epoch seconds in quotes", message(createdAt="1749772800"), ("createdAt", 1749772800000)),
    ("epoch fraction", message(createdAt=1749772800.123), ("createdAt", 1749772800123)),
    ("no zone", message(createdAt="2026-06-13T00:00:00"), None),
    ("no zone inside", message(measurement={"measuredAt": "2026-06-13T00:00:00"}), None),
    ("offset", message(createdAt="2026-06-13T09:00:00+09:00"), ("createdAt", 1781308800000)),
    ("below a milli", message(createdAt="2026-06-13T00:00:00.123999Z"), ("createdAt", 1781308800123)),
    ("single quotes", "{'batchId':'B'}", None),
    ("bare NaN", message({"value": float("nan")}), None),
    ("null element", message(measurements=[None]), ("measurements", [None])),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, text, i) for i, (name, text, _) in enumerate(CASES)]
    messages = spark.createDataFrame(rows, "name string, value string, arrival_seq long")
    return {row.name: row.batch for row in parse_messages(messages).collect()}


@pytest.mark.parametrize("name, text, expected", CASES, ids=[c[0] for c in CASES])
def test_case(parsed, name, text, expected):
    batch = parsed[name]
    if expected is None:
        assert batch is None
        return
    field, value = expected
    if field == "value":
        assert batch.measurements[0].sensors[0].value == value
    elif field == "createdAt":
        assert batch.createdAt.timestamp() * 1000 == pytest.approx(value, abs=0.5)
    else:
        assert batch[field] == value


def test_poison_is_set_aside_and_counted(spark):
    from pyspark.sql import Observation

    rows = [(text, i) for i, (_, text, _) in enumerate(CASES)]
    parsed = parse_messages(spark.createDataFrame(rows, "value string, arrival_seq long"))
    skipped = [c for c in CASES if c[2] is None]
    silent = {None, "", "null"}
    poison = poison_messages(parsed).collect()
    assert sorted(r.value for r in poison) == sorted(c[1] for c in skipped if c[1] not in silent)
    assert valid_batches(parsed).count() == len(CASES) - len(skipped)
    seen = Observation("messages")
    parsed.observe(seen, F.count("batch").alias("valid")).collect()
    assert seen.get["valid"] == len(CASES) - len(skipped)
    assert count_messages(parsed).columns == parsed.columns


def test_arrival_of_two_partitions(spark):
    rows = [(offset, partition) for offset in (0, 1, 7) for partition in (0, 1)]
    table = spark.createDataFrame(rows, "offset bigint, partition int")
    arrived = [r[0] for r in table.select(topic_arrival()).collect()]
    assert sorted(set(arrived)) == arrived
    with pytest.raises(Exception, match="partitions"):
        spark.createDataFrame([(0, 4096)], "offset bigint, partition int").select(topic_arrival()).collect()


def batches(spark, *rows):
    return spark.createDataFrame([(row, i) for i, row in enumerate(rows)],
                                 "batch " + BATCH.simpleString() + ", arrival_seq long")


def sensor(name):
    return (name, "TEMP", 21.0, 10.0, 30.0, "C", "OK")


def test_flatten_pairs(spark):
    at = instant(1781308800000)
    later = instant(1781308805000)
    batch = ("B1", "D1", 1, at, 5, [(0, at, "M", [sensor("S1"), sensor("S2")]), (1, later, "M", [sensor("S1")])])
    rows = flatten_batches(batches(spark, batch)).orderBy("element_seq").collect()
    assert [(r.sequence, r.sensor_id) for r in rows] == [(0, "S1"), (0, "S2"), (1, "S1")]
    first = rows[0]
    assert (first.batch_id, first.equipment_id, first.measurement_status, first.sensor_status) == (
        "B1", 1, "M", "OK",
    )
    assert first.measured_at.replace(tzinfo=UTC) == at
    assert flatten_batches(batches(spark, batch)).schema.fieldNames() == READING.fieldNames()


def test_flatten_skips_missing_parts(spark):
    at = instant(1781308800000)
    rows = flatten_batches(
        batches(
            spark,
            None,
            ("B1", "D", 1, at, 5, None),
            ("B2", "D", 1, at, 5, [None, (0, at, "M", [sensor("S1"), None])]),
            ("B3", "D", 1, at, 5, [(0, at, "M", None)]),
            ("B4", "D", 1, None, 5, [(0, None, "M", [sensor("S1")])]),
            ("B5", "D", 1, at, 5, [(0, None, "M", [sensor("S1")])]),
            ("B6", "D", 1, None, 5, [(0, at, "M", [sensor("S1")])]),
        )
    ).collect()
    found = {r.batch_id: (r.measured_at.replace(tzinfo=UTC), r.created_at.replace(tzinfo=UTC)) for r in rows}
    assert found == {"B2": (at, at), "B5": (at, at), "B6": (at, instant(0))}


def test_messages_to_readings(spark):
    rows = spark.createDataFrame([(message(), 7), ("}{", 8)], "value string, arrival_seq long")
    (row,) = readings_of(rows).collect()
    assert (row.batch_id, row.equipment_id, row.value, row.arrival_seq) == ("B1", 1, 21.0, 7)


ODD = [
    ("number beyond a double", message({"value": 1}).replace('"value": 1', '"value": 1e400'), float("inf")),
    ("the same in a text", message({"value": '"Infinity"'}), None),
    ("two leaves in one", message({"value": "5\x016"}), None),
    ("last day of a month", message({"value": 2}, createdAt="2026-01-31T00:00:00Z"), 2.0),
    ("no such day", message(createdAt="2026-04-31T00:00:00Z"), None),
    ("beside a missing list", message().replace('"measurements": [', '"measurements": [null, '), 21.0),
    ("lost beside a missing list", message({"value": "x"}).replace('"measurements": [', '"measurements": [null, '), None),
]


@pytest.mark.parametrize("name, text, value", ODD, ids=[c[0] for c in ODD])
def test_odd_leaf(spark, name, text, value):
    (row,) = parse_messages(spark.createDataFrame([(text, 1)], "value string, arrival_seq long")).collect()
    found = None if row.batch is None else row.batch.measurements[-1].sensors[0].value
    assert found == value


def test_a_message_is_read_once(spark):
    """Neither numbers in quotes nor broken messages are read a second time, and the JVM compiles every method."""
    parsed = parse_messages(spark.createDataFrame([(message(), 1)], "value string, arrival_seq long"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "from_json" in line]
    assert sum("CASE WHEN" not in line.split("from_json")[0] for line in reads) == 1
    assert all("_way" in line.split("from_json")[0] for line in reads if "CASE WHEN" in line.split("from_json")[0])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", parsed._jdf.queryExecution().explainString(mode))
    assert sizes and max(map(int, sizes)) < 8000
