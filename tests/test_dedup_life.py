"""E1 with a time to live in batch, against a loop over each key's copies."""

from __future__ import annotations

import random

import pytest
from helpers import frame, instant, reading

from kilnwatch.operators.dedup import first_copies, first_copies_with_life

START = 1_749_686_400_000


def kept_by_loop(rows, ttl_ms):
    last, out = {}, []
    for row in sorted(rows, key=lambda r: (r["measured_at"], r["arrival_seq"])):
        key = tuple(row[c] for c in ("batch_id", "equipment_id", "sequence", "sensor_id"))
        ms = row["measured_at"]
        if key not in last or (ms - last[key]).total_seconds() * 1000 >= ttl_ms:
            last[key] = ms
            out.append(row["arrival_seq"])
    return sorted(out)


def history(seed, count, spread_ms):
    rng = random.Random(seed)
    times = [rng.randrange(spread_ms) // rng.choice([1, 1, 500]) for _ in range(count)]
    return [
        reading(
            measured_at=instant(START + t), arrival_seq=i, sensor_id=rng.choice(["hot", "hot", "a", "b", None]),
            sequence=rng.choice([1, 1, 1, 2, None]),
        )
        for i, t in enumerate(times)
    ]


def found(rows):
    return sorted(r.arrival_seq for r in rows.collect())


@pytest.mark.parametrize("seed, ttl_ms", [(1, 1), (2, 1000), (3, 7_777), (4, 59_999), (5, 10**9)])
def test_random_copies(spark, seed, ttl_ms):
    rows = history(seed, 700, 60_000)
    readings = frame(spark, rows).repartition(4)
    kept = first_copies_with_life(readings, "measured_at", ttl_ms)
    assert kept.columns == readings.columns
    assert found(kept) == kept_by_loop(rows, ttl_ms)


def test_a_life_ends_exactly(spark):
    times = [0, 999, 1000, 1999, 2000, 2500, 9000]
    rows = [reading(measured_at=instant(START + t), arrival_seq=i) for i, t in enumerate(times)]
    assert found(first_copies_with_life(frame(spark, rows), "measured_at", 1000)) == [0, 2, 4, 6]


def test_equal_times_and_equal_order(spark):
    rows = [reading(measured_at=instant(START), arrival_seq=a) for a in (3, 1, 2, 1)]
    assert found(first_copies_with_life(frame(spark, rows), "measured_at", 1000)) == [1]


def test_a_long_life_is_first_copies(spark):
    rows = history(9, 300, 60_000)
    for row in rows:
        row["arrival_seq"] = int(row["measured_at"].timestamp() * 1000) * 1000 + row["arrival_seq"]
    readings = frame(spark, rows)
    assert found(first_copies_with_life(readings, "measured_at", 10**9)) == found(first_copies(readings))


def test_no_rows_and_bad_lives(spark):
    assert found(first_copies_with_life(frame(spark, []), "measured_at", 1000)) == []
    for ttl in (0, -1):
        with pytest.raises(ValueError):
            first_copies_with_life(frame(spark, []), "measured_at", ttl)
