"""Streams against the plain loop, with disorder and several micro-batches."""

from __future__ import annotations

import shutil
import time
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from fold import evaluate, random_readings, transitions
from helpers import evaluation_tuples, frame, from_fold, instant, reading, tidy

from kilnwatch.functions.keys import dedup_key
from kilnwatch.options import JobOptions, RuleOptions
from kilnwatch.schemas import READING
from kilnwatch.session import shared_folder
from kilnwatch.sinks.alerts import alert_files
from kilnwatch.sinks.documents import read_latest
from kilnwatch.sinks.storage import PARTITIONS
from kilnwatch.sources.messages import read_message_files
from kilnwatch.streaming.dedup import first_copies_with_ttl, first_copies_within_watermark
from kilnwatch.streaming.jobs import (
    landed_poison,
    landed_readings,
    run,
    start,
    stored_once,
    to_documents,
    to_files,
    to_landing,
)
from kilnwatch.streaming.monitor import monitor

OPTIONS = RuleOptions(
    limit_window_ms=20_000, trend_window_ms=8_000, min_batches=4, min_trend_samples=4,
    min_bias_samples=8,
)


def land(spark, path, rows, parts=1):
    """Write rows in order as one file per part; streams read files by time of writing."""
    size = -(-len(rows) // parts)
    for at in range(0, len(rows), size):
        frame(spark, rows[at : at + size]).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)


def drain(writer, spark):
    query = (
        writer.option("checkpointLocation", shared_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)


def one_file_at_a_time(spark, path):
    return spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("seed, disorder_ms", [(11, 0), (12, 30_000)])
def test_monitor_equals_the_loop(spark, seed, disorder_ms):
    rows = random_readings(seed, 400, disorder_ms)
    source = shared_folder(spark, "readings")
    land(spark, source, from_fold(rows), parts=3)
    expected = evaluate(rows, OPTIONS)
    for changes_only in (False, True):
        path = shared_folder(spark, "found")
        stream = monitor(one_file_at_a_time(spark, source), OPTIONS, changes_only)
        drain(to_files(stream, path), spark)
        wanted = transitions(expected) if changes_only else expected
        assert evaluation_tuples(spark.read.parquet(path)) == tidy(wanted)


def test_dedup_within_watermark(spark):
    rows = [reading(arrival_seq=i, sequence=i % 5, batch_id=f"B{i % 2}") for i in range(40)]
    source, path = shared_folder(spark, "copies"), shared_folder(spark, "kept")
    land(spark, source, rows, parts=2)
    stream = one_file_at_a_time(spark, source).withColumnRenamed("created_at", "ingested_at")
    stream = stream.withColumn("created_at", stream["ingested_at"])
    drain(to_files(first_copies_within_watermark(stream, "ingested_at"), path), spark)
    keys = [r[0] for r in spark.read.parquet(path).select(dedup_key()).collect()]
    assert len(keys) == len(set(keys)) == 10


@pytest.mark.parametrize("ttl_ms, expected", [(3_600_000, [0]), (1, [0, 2])])
def test_dedup_with_ttl(spark, ttl_ms, expected):
    """A copy in a later micro-batch passes only once the mark has expired."""
    source, path = shared_folder(spark, "copies"), shared_folder(spark, "kept")
    together = frame(spark, [reading(arrival_seq=0), reading(arrival_seq=1)])
    together.coalesce(1).write.parquet(source)
    query = (
        to_files(first_copies_with_ttl(one_file_at_a_time(spark, source), ttl_ms), path)
        .option("checkpointLocation", shared_folder(spark, "checkpoint"))
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        deadline = time.time() + 60
        for arrival in (2, None):
            while time.time() < deadline and seen_batches(query) < (1 if arrival else 2):
                time.sleep(0.5)
            if arrival:
                time.sleep(1)
                frame(spark, [reading(arrival_seq=arrival)]).write.mode("append").parquet(source)
    finally:
        query.stop()
    kept = spark.read.schema(READING).parquet(path)
    assert sorted(r.arrival_seq for r in kept.collect()) == expected


def seen_batches(query) -> int:
    return sum(1 for p in query.recentProgress if p.numInputRows)


@pytest.mark.parametrize("ttl_ms", [0, -1000, None])
def test_dedup_ttl_must_be_positive(spark, ttl_ms):
    with pytest.raises(ValueError):
        first_copies_with_ttl(frame(spark, []), ttl_ms)


def test_documents_stream(spark):
    rows = [reading(arrival_seq=i, value=float(i), measured_at=instant(i % 3)) for i in range(9)]
    source, path = shared_folder(spark, "readings"), shared_folder(spark, "documents")
    land(spark, source, rows, parts=3)
    drain(to_documents(one_file_at_a_time(spark, source), path), spark)
    assert sorted(r.value for r in read_latest(spark, path).collect()) == [6.0, 7.0, 8.0]


def test_messages_to_storage(spark):
    """Landing and storage as two queries with checkpoints of their own."""
    messages, base = shared_folder(spark, "messages"), shared_folder(spark, "job")
    text = (
        '{"batchId":"B","deviceId":"D","id":1,"createdAt":"2026-06-13T00:00:00Z","measurements":'
        '[{"sequence":1,"sensors":[{"sensorId":"S1","value":1.5},{"sensorId":"S2"}]}]}'
    )
    spark.createDataFrame([(text,), (text,), ("}{",)], "value string").write.text(messages)
    options = JobOptions(
        checkpoint_dir=f"{base}/checkpoints", checkpoint_interval_ms=500, exact_dedup=False
    )
    source = read_message_files(spark, messages, streaming=True)
    for name, writer in (
        ("landing", lambda: to_landing(source, f"{base}/landing", "7d")),
        (
            "storage",
            lambda: to_files(
                stored_once(landed_readings(spark, f"{base}/landing"), options),
                f"{base}/readings", *PARTITIONS,
            ),
        ),
    ):
        query = start(writer(), options, name)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    assert spark.read.parquet(f"{base}/landing").where("kind = 'reading'").count() == 4
    stored = spark.read.parquet(f"{base}/readings")
    assert sorted((r.sensorId, r.value, r.device) for r in stored.collect()) == [
        ("S1", 1.5, "D"), ("S2", None, "D"),
    ]


def test_one_landing_feeds_three_branches(spark):
    """G2 on files: parsed once; storage, documents, alerts and quarantine from it."""
    messages, base = shared_folder(spark, "messages"), shared_folder(spark, "job")
    text = (
        '{"batchId":"B","deviceId":"D","id":1,"createdAt":"2026-06-13T00:00:00Z","measurements":'
        '[{"sequence":1,"sensors":[{"sensorId":"S1","value":1.5},{"sensorId":"S2"}]}]}'
    )
    spark.createDataFrame([(text,), (text,), ("}{",), ("",)], "value string").write.text(messages)
    source = read_message_files(spark, messages, streaming=True)
    checkpoint = shared_folder(spark, "checkpoint")
    for _ in range(2):
        query = (
            to_landing(source, f"{base}/landing")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        assert query.awaitTermination(120)
    counted = [p.observedMetrics for p in query.recentProgress if "messages" in p.observedMetrics]
    assert all(set(c["messages"].asDict()) == {"received", "valid", "skipped"} for c in counted)
    assert [r.poison for r in landed_poison(spark, f"{base}/landing").collect()] == ["}{"]

    def landed():
        return landed_readings(spark, f"{base}/landing", max_files=2)

    options = JobOptions()
    drain(to_files(stored_once(landed(), options), f"{base}/readings", *PARTITIONS), spark)
    drain(to_documents(landed(), f"{base}/documents"), spark)
    drain(alert_files(monitor(landed(), RuleOptions(min_batches=0)), f"{base}/alerts"), spark)
    stored = spark.read.parquet(f"{base}/readings").collect()
    assert sorted((r.sensorId, r.value) for r in stored) == [("S1", 1.5), ("S2", None)]
    assert read_latest(spark, f"{base}/documents").count() == 2
    assert spark.read.text(f"{base}/alerts").count() > 0


def test_a_killed_landing_lands_every_reading_once(spark, tmp_path):
    """The first run dies while files are written; what it and another writer left behind is read by nobody."""
    text = (
        '{"batchId":"B","deviceId":"D","id":%d,"createdAt":"2026-06-13T00:00:00Z","measurements":'
        '[{"sequence":1,"sensors":[{"sensorId":"S1","value":1.5}]}]}'
    )
    rows = spark.createDataFrame([(text % i, i) for i in range(40)] + [("}{", 40)], "value string, arrival_seq bigint")
    source, base, mark = shared_folder(spark, "killed-source"), shared_folder(spark, "killed"), tmp_path / "dead"
    rows.repartition(8).write.parquet(source)
    landing, checkpoint = f"{base}/landing", shared_folder(spark, "checkpoint")

    def dying(batches):
        for batch in batches:
            if (batch["arrival_seq"] == 17).any() and not mark.exists():
                mark.touch()
                time.sleep(5)
                raise RuntimeError("killed")
            yield batch

    def attempt():
        stream = spark.readStream.schema(rows.schema).parquet(source)
        return (
            to_landing(stream.mapInPandas(dying, rows.schema), landing)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    with pytest.raises(StreamingQueryException):
        attempt().awaitTermination(120)
    for _ in range(2):
        assert attempt().awaitTermination(120)
    # A file that a killed writer did not live to publish.
    part = next(Path(landing, "kind=reading").glob("part-*.parquet"))
    shutil.copy(part, part.with_name("part-99999-left-behind.snappy.parquet"))
    assert len(list(Path(landing).rglob("part-*"))) > len(set(spark.read.parquet(landing).inputFiles()))

    path = f"{base}/alerts"
    drain(alert_files(monitor(landed_readings(spark, landing), RuleOptions(min_batches=0), False), path), spark)
    found = spark.read.json(path).selectExpr("payload.equipmentId AS id", "payload.ruleName AS rule").collect()
    assert sorted(r.id for r in found if r.rule == "NELSON_RULE_3") == list(range(40))
    assert [r.arrival_seq for r in landed_poison(spark, landing).collect()] == [40]


def test_job_needs_a_checkpoint_folder(spark):
    with pytest.raises(ValueError):
        run(spark, JobOptions())
