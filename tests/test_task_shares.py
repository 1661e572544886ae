"""What one task holds of the samples, however many there are."""

from __future__ import annotations

import pytest
from fold import evaluate, random_readings
from helpers import evaluation_tuples, frame, from_fold, reading, tidy
from pyspark.sql import functions as F

from kilnwatch.operators import slices, trailing
from kilnwatch.operators.trailing import trailing_samples
from kilnwatch.options import RuleOptions
from kilnwatch.plans.alerts import evaluations

HALF_HOUR = 1_800_000


def busy_sensor(spark, count: int):
    start = 1_700_000_000_000 // HALF_HOUR * HALF_HOUR
    rows = spark.range(count).select(
        F.timestamp_millis(F.lit(start) + F.col("id") * 100).alias("measured_at"), F.col("id").alias("arrival_seq")
    )
    return rows.crossJoin(F.broadcast(frame(spark, [reading()]).drop("measured_at", "arrival_seq")))


@pytest.mark.parametrize("plan", ["trailing", "rules"])
def test_partitions_grow_with_the_samples(spark, monkeypatch, plan):
    """A task's share stays the same however many samples there are, and however few partitions the session has."""
    monkeypatch.setattr(slices, "SAMPLES_A_TASK", 500, raising=False)
    monkeypatch.setattr(trailing, "MOST_IN_STRETCH", 50, raising=False)
    monkeypatch.setattr(trailing, "FEWEST_IN_STRETCH", 10, raising=False)
    count = 18_000
    readings = busy_sensor(spark, count)
    if plan == "trailing":
        found = trailing_samples(readings, HALF_HOUR, HALF_HOUR)
    else:
        found = evaluations(readings, RuleOptions(min_batches=1, slice_ms=HALF_HOUR), ("NELSON_RULE_1",))
    sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == count
    assert max(sizes) < 1500


@pytest.mark.parametrize("seed", [1, 2])
def test_stretches_of_a_few_samples_find_the_same(spark, monkeypatch, seed):
    monkeypatch.setattr(trailing, "MOST_IN_STRETCH", 2, raising=False)
    monkeypatch.setattr(trailing, "FEWEST_IN_STRETCH", 1, raising=False)
    options = RuleOptions(
        limit_window_ms=20_000, trend_window_ms=8_000, min_batches=4, min_trend_samples=4, min_bias_samples=8,
        slice_ms=120_000,
    )
    rows = random_readings(seed, 400)
    readings = frame(spark, from_fold(rows))
    assert trailing.spread(readings, options.slice_length_ms)[0] < trailing.stretch_length(options.slice_length_ms)
    assert evaluation_tuples(evaluations(readings, options)) == tidy(evaluate(rows, options))


def test_crowded_moments_leave_stretches_long(spark, monkeypatch):
    """Many copies of one moment do not cut the rest into a stretch for each sample."""
    monkeypatch.setattr(trailing, "MOST_IN_STRETCH", 10)
    monkeypatch.setattr(trailing, "FEWEST_IN_STRETCH", 5)
    sparse = [reading(measured_at=None), *(reading(arrival_seq=i) for i in range(200))]
    apart = F.timestamp_millis(F.unix_millis("measured_at") + F.col("arrival_seq") * HALF_HOUR)
    readings = frame(spark, sparse).unionByName(busy_sensor(spark, 180).withColumn("measured_at", apart))
    assert trailing.spread(readings, HALF_HOUR) == (trailing.stretch_length(HALF_HOUR), 380)
    assert trailing.spread(readings.limit(0), HALF_HOUR) == (trailing.stretch_length(HALF_HOUR), 0)
