"""The physical plans: shuffles, pruning, no Python in batch."""

from __future__ import annotations

import re
import time
from pathlib import Path

import pytest
from helpers import frame, instant, reading
from pyspark.sql import functions as F

from kilnwatch.operators.dedup import first_copies
from kilnwatch.operators.flatten import flatten_batches
from kilnwatch.operators.latest import latest_documents
from kilnwatch.operators.projections import documents
from kilnwatch.options import RuleOptions
from kilnwatch.plans.alerts import alerts, evaluations
from kilnwatch.plans.catalog import RULES
from kilnwatch.schemas import BATCH
from kilnwatch.session import shared_folder
from kilnwatch.sources.tables import event_rows, readings_from_events

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@needs_tables
def test_alert_shuffles(spark, no_broadcast):
    text = plan(alerts(readings_from_events(event_rows(spark, SF_DIR)), RULES))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    keys = [tuple(re.sub(r"#\d+L?", "", k) for k in e.split(", ")[:-1]) for e in exchanges]
    assert sorted(keys) == sorted(
        [
            ("stream_key", "slice_start"),  # readings
            ("stream_key", "slice_start"),  # batch ids only, for the gate
            ("stream_key",),  # a handful of batch changes per slice
            ("stream_key", "slice_start"),  # one gate position per slice
            ("stream_key", "rule_name", "_group"),  # alerts and slice edges
        ]
    )
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    assert "sensor_status" not in text and "measurement_status" not in text


@needs_tables
def test_evaluations_shuffle_readings_once(spark):
    options = RuleOptions(min_batches=0)
    text = plan(evaluations(readings_from_events(event_rows(spark, SF_DIR)), options))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


@needs_tables
def test_copies_are_limited_before_the_shuffle(spark):
    readings = readings_from_events(event_rows(spark, SF_DIR))
    for rows in (first_copies(readings), latest_documents(readings)):
        text = plan(rows)
        assert re.search(r"Exchange.*?WindowGroupLimit", text, re.S)
        assert text.count("WindowGroupLimit") == 2


def test_one_busy_sensor_is_spread(spark):
    """A sensor's history is split by time, whatever its share of all readings."""
    rows = spark.range(200_000).select(
        F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id") * 1000).alias("measured_at"),
        F.col("id").alias("arrival_seq"),
    )
    template = frame(spark, [reading()]).drop("measured_at", "arrival_seq")
    readings = rows.crossJoin(F.broadcast(template))
    found = evaluations(readings, RuleOptions(min_batches=0))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 600_000 and len(sizes) == 4
    assert max(sizes) < 0.5 * sum(sizes)


def test_flatten_and_mapping_rate(spark):
    """One million readings, from batches of 20 sensors and 10 measurements."""
    at = instant(1781308800000)
    sensors = [(f"S{i}", "TEMP", 20.0 + i, 10.0, 30.0, "C", "OK") for i in range(20)]
    batch = ("B", "D", 1, at, 1, [(m, at, "OK", sensors) for m in range(10)])
    one = spark.createDataFrame([(batch,)], "batch " + BATCH.simpleString())
    path = shared_folder(spark, "rate")
    one.crossJoin(spark.range(5000).withColumnRenamed("id", "arrival_seq")).write.parquet(path)
    batches = spark.read.parquet(path)
    rows = documents(flatten_batches(batches))
    best = float("inf")
    for _ in range(3):
        begin = time.perf_counter()
        rows.write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - begin)
    assert rows.count() == 1_000_000
    threads = spark.sparkContext.defaultParallelism
    assert 1_000_000 / best / threads > 50_000
