"""Dedup in batch, partitioned storage and the latest-document table."""

from __future__ import annotations

from pathlib import Path

import pytest
from helpers import frame, instant, reading

from kilnwatch.operators.dedup import first_copies
from kilnwatch.operators.latest import latest_documents
from kilnwatch.session import shared_folder
from kilnwatch.sinks.documents import compact, merge, read_latest, read_rejected, run_of, upsert, vacuum
from kilnwatch.sinks.storage import PARTITIONS, write_storage


def test_first_copy_wins(spark):
    rows = [
        reading(arrival_seq=5, value=5.0),
        reading(arrival_seq=2, element_seq=1, value=2.1),
        reading(arrival_seq=2, element_seq=0, value=2.0),
        reading(arrival_seq=3, sensor_id="S2"),
        reading(arrival_seq=4, sequence=3),
        reading(arrival_seq=9, batch_id="C"),
    ]
    kept = first_copies(frame(spark, rows)).orderBy("arrival_seq").collect()
    assert [(r.arrival_seq, r.value) for r in kept] == [(2, 2.0), (3, 21.5), (4, 21.5), (9, 21.5)]


def test_storage_layout(spark):
    path = shared_folder(spark, "storage-test")
    at = instant(1781364245678)
    rows = [
        reading(device_id="EQP-001", created_at=at),
        reading(device_id="../../etc/passwd", created_at=at, value=None),
        reading(device_id=" ", created_at=instant(0)),
    ]
    write_storage(frame(spark, rows), path)
    files = {str(f.parent.relative_to(path)) for f in Path(path).rglob("*.snappy.parquet")}
    assert files == {
        "year=2026/month=06/day=13/device=EQP-001",
        "year=2026/month=06/day=13/device=.._.._etc_passwd",
        "year=1970/month=01/day=01/device=unknown",
    }
    stored = spark.read.parquet(path).filter("year = 2026 and device = 'EQP-001'")
    assert stored.count() == 1 and len(set(stored.columns) - set(PARTITIONS)) == 15
    assert stored.first().createdAt.microsecond == 678000
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def values(rows):
    return sorted((r.document_id, r.value) for r in rows.collect())


def test_latest_document(spark):
    rows = [
        reading(arrival_seq=1, value=1.0),
        reading(arrival_seq=3, value=None, unit=None),
        reading(arrival_seq=2, value=2.0),
        reading(arrival_seq=0, sensor_id=None, value=9.0),
    ]
    assert values(latest_documents(frame(spark, rows))) == [("1_S1_2000", None), ("1__2000", 9.0)]


def test_upserts_replace_and_repeat(spark):
    path, smaller = shared_folder(spark, "documents-test"), shared_folder(spark, "compact-test")
    day = 86_400_000
    first = [reading(arrival_seq=i, measured_at=instant(i * day), value=float(i)) for i in range(4)]
    second = [reading(arrival_seq=0, measured_at=instant(day), value=10.0)]
    broken = reading(arrival_seq=9, measured_at=instant(2 * day), value=float("nan"))
    upsert(frame(spark, first), path, 0)
    upsert(frame(spark, [*second, broken]), path, 1)
    expected = [
        ("1_S1_0", 0.0), ("1_S1_172800000", 2.0), ("1_S1_259200000", 3.0), ("1_S1_86400000", 10.0),
    ]
    assert values(read_latest(spark, path)) == expected
    upsert(frame(spark, [*second, broken]), path, 1)
    assert values(read_latest(spark, path)) == expected
    assert read_rejected(spark, path).count() == 1
    compact(spark, path, smaller)
    assert values(read_latest(spark, smaller)) == expected
    upsert(frame(spark, [reading(measured_at=instant(0), value=7.0)]), smaller, 2)
    assert ("1_S1_0", 7.0) in values(read_latest(spark, smaller))


def test_a_new_checkpoint_keeps_the_old_epochs(spark):
    path = shared_folder(spark, "restart-test")
    rows = [reading(arrival_seq=i, measured_at=instant(i), value=float(i)) for i in range(6)]
    checkpoints = [shared_folder(spark, "checkpoint") for _ in range(2)]
    runs = [run_of(spark, checkpoint) for checkpoint in checkpoints]
    assert runs == [run_of(spark, checkpoint) for checkpoint in checkpoints] and runs[0] < runs[1]
    upsert(frame(spark, rows[:4]), path, 0, runs[0])
    upsert(frame(spark, rows[3:]), path, 0, runs[1])
    assert len(values(read_latest(spark, path))) == 6
    upsert(frame(spark, rows[:4]), path, 0, runs[0])
    assert len(values(read_latest(spark, path))) == 6


def test_unpublished_and_missing_changes_are_not_read(spark):
    path = shared_folder(spark, "unpublished-test")
    assert values(read_latest(spark, path)) == [] and read_rejected(spark, path).count() == 0
    upsert(frame(spark, [reading(value=1.0)]), path, 0)
    half = f"{path}/changes/run=0/epoch=1/attempt=broken/measured_day=1970-01-01"
    files = next(Path(path).glob("changes/run=0/epoch=0/*/measured_day=*"))
    spark.read.parquet(str(files)).write.parquet(half)
    assert values(read_latest(spark, path)) == [("1_S1_2000", 1.0)]


def test_one_day_of_documents_reads_one_day(spark):
    path = shared_folder(spark, "documents-pruning")
    rows = [reading(measured_at=instant(i * 86_400_000)) for i in range(3)]
    upsert(frame(spark, rows), path, 0)
    plan = (
        read_latest(spark, path)
        .filter("measured_day = date'1970-01-02'")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "PartitionFilters: [isnotnull(measured_day" in plan


def folders(path, kind="changes"):
    return sorted(str(p.parent.relative_to(path)) for p in Path(path).glob(f"{kind}/*/*/*/_SUCCESS"))


def test_merges_bound_the_batches_and_lose_nothing(spark):
    """Two runs write in turn, with a rejected reading each; merges and vacuums in between change nothing to readers."""
    path, runs = shared_folder(spark, "merge-test"), ["a", "b"]
    latest, rejected = {}, 0

    def epoch_rows(number, run):
        rows = [
            reading(arrival_seq=k, measured_at=instant((number * (k + 1)) % 7 * 43_200_000), value=float(100 * number + k))
            for k in range(3)
        ]
        return rows, [reading(measured_at=instant(number), value=float("nan"), sensor_id=run)]

    for number in range(13):
        for run in runs:
            rows, broken = epoch_rows(number, run)
            upsert(frame(spark, [*rows, *broken]), path, number, run)
            rejected += 1
            for k, row in enumerate(rows):
                key = f"1_S1_{int(row['measured_at'].timestamp() * 1000)}"
                latest[key] = max(latest.get(key, ("", 0, 0, 0.0)), (run, number, k, row["value"]))
        if number in (5, 6, 9, 12):
            pinned = read_latest(spark, path)
            before = values(pinned)
            merge(spark, path, fanout=3, newest_kept=2)
            assert values(read_latest(spark, path)) == before == values(pinned)
        if number == 9:
            assert vacuum(spark, path, 3_600_000_000) == 0
            assert vacuum(spark, path, 0) > 0 and vacuum(spark, path, 0) == 0
    expected = sorted((key, found[-1]) for key, found in latest.items())
    assert values(read_latest(spark, path)) == expected
    # A restart repeats an epoch: a merged one stays replaced, one of the newest is written anew.
    for number in (0, 12):
        upsert(frame(spark, sum(epoch_rows(number, "a"), [])), path, number, "a")
    assert values(read_latest(spark, path)) == expected
    assert read_rejected(spark, path).count() == rejected
    # Two epochs of each run, and less than the fan-out on every level.
    read = [f for f in spark.read.parquet(f"{path}/commits").collect()]
    assert len(read_latest(spark, path).inputFiles()) <= 10 * 4 < len(read) * 4
    vacuum(spark, path, 0)
    assert values(read_latest(spark, path)) == expected and read_rejected(spark, path).count() == rejected
    assert len(folders(path)) <= 4 + 2 * 3


def test_a_merge_that_died_changes_nothing(spark, monkeypatch):
    path = shared_folder(spark, "dead-merge")
    for number in range(6):
        upsert(frame(spark, [reading(arrival_seq=0, value=float(number))]), path, number)
    with monkeypatch.context() as dying:
        dying.setattr("kilnwatch.sinks.documents._publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge(spark, path, fanout=2)
    assert values(read_latest(spark, path)) == [("1_S1_2000", 5.0)]
    assert merge(spark, path, fanout=2) == 1
    assert values(read_latest(spark, path)) == [("1_S1_2000", 5.0)]
