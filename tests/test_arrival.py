"""Sample sets in order of arrival and with limits of each reading's own, against plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest
from fold import evaluate, random_readings, transitions
from helpers import evaluation_tuples, frame, from_fold, instant, reading, tidy

from kilnwatch.operators import arrival
from kilnwatch.operators.arrival import late_readings
from kilnwatch.operators.sample_sets import FEW, Beyond, Samples, Smaller, limit_figures, trailing
from kilnwatch.options import RuleOptions
from kilnwatch.plans.alerts import alerts, evaluations

SMALL = dict(
    limit_window_ms=20_000, trend_window_ms=8_000, min_batches=4, min_trend_samples=4, min_bias_samples=8,
)


def with_own_limits(rows, seed):
    rng = random.Random(seed)
    for row in rows:
        low = rng.choice([None, float("nan"), 8.0, *[rng.uniform(0, 30) for _ in range(9)]])
        high = rng.choice([None, 25.0, 3.0, *[rng.uniform(10, 45) for _ in range(9)]])
        row |= {"recipe_min": low, "recipe_max": high}
    return rows


@pytest.mark.parametrize(
    "seed, disorder_ms, own, slice_ms, slice_arrivals",
    [
        (21, 3_000, False, 20_000, 50),
        (22, 30_000, False, 33_333, 7),
        (23, 90_000, True, 20_000, 1 << 20),
        (24, 15_000, True, 10_000_000, 100),
        (25, 0, True, 25_000, 1),
    ],
)
def test_random_history_in_order_of_arrival(spark, monkeypatch, seed, disorder_ms, own, slice_ms, slice_arrivals):
    monkeypatch.setattr(arrival, "ROWS_AT_ONCE", 40)
    rows = random_readings(seed, 600, disorder_ms)
    if own:
        rows = with_own_limits(rows, seed)
    options = RuleOptions(**SMALL, slice_ms=slice_ms, in_arrival_order=True, slice_arrivals=slice_arrivals)
    expected = evaluate(rows, options)
    readings = frame(spark, from_fold(rows)).repartition(6).cache()
    assert evaluation_tuples(evaluations(readings, options)) == tidy(expected)
    assert evaluation_tuples(alerts(readings, options)) == tidy(transitions(expected))


@pytest.mark.parametrize("slice_ms", [20_000, 10_000_000])
def test_own_limits_in_order_of_time(spark, slice_ms):
    rows = with_own_limits(random_readings(31, 500), 31)
    options = RuleOptions(**SMALL, slice_ms=slice_ms, own_limits=True)
    expected = evaluate(rows, options)
    readings = frame(spark, from_fold(rows)).repartition(3).cache()
    assert evaluation_tuples(evaluations(readings, options)) == tidy(expected)
    assert evaluation_tuples(alerts(readings, options)) == tidy(transitions(expected))
    plain = RuleOptions(**SMALL, slice_ms=slice_ms)
    assert evaluation_tuples(evaluations(readings, plain)) == tidy(expected)


def test_what_was_pushed_out_stays_out(spark):
    # The sample at 0 goes when 21 s arrives, and a late one at 5 s does not bring it back.
    times = [0, 6_000, 21_000, 5_000, 30_000, 2_000, 2_500, 14_000]
    rows = [
        reading(measured_at=instant(10**9 + t), arrival_seq=i, value=float(i), recipe_min=None, recipe_max=-1.0)
        for i, t in enumerate(times)
    ]
    options = RuleOptions(limit_window_ms=20_000, trend_window_ms=20_000, min_batches=0, in_arrival_order=True)
    found = evaluations(frame(spark, rows), options).filter("rule_name = 'NELSON_RULE_1'").orderBy("arrival_seq")
    assert [(r.sample_count, r.measured_value) for r in found.collect()] == [
        (1, 0.0), (2, 1.0), (2, 2.0), (3, 2.0), (2, 4.0), (3, 4.0), (4, 4.0), (5, 4.0),
    ]


def test_late_readings_are_counted(spark):
    times = [0, 400_000, 399_999, 50_000, 400_000, 700_001]
    rows = [reading(measured_at=instant(10**9 + t), arrival_seq=i) for i, t in enumerate(times)]
    rows += [reading(sensor_id="S2", measured_at=instant(10**9), arrival_seq=i) for i in range(3)]
    for stretch in (1, 2, 100):
        found = late_readings(frame(spark, rows), RuleOptions(slice_arrivals=stretch)).collect()
        assert sorted(tuple(r) for r in found) == [(1, "S1", 6, 2, 1, 350_000), (1, "S2", 3, 0, 0, 0)]


def test_no_readings(spark):
    for options in (RuleOptions(in_arrival_order=True), RuleOptions(own_limits=True)):
        assert alerts(frame(spark, []), options).collect() == []


def sensors(seed, late, limits):
    """Samples of some sensors with their limits, and the sets by definition."""
    rng = random.Random(seed)
    starts, ms, values, window = [], [], [], 50
    for _ in range(rng.randint(1, 5)):
        starts.append(len(ms))
        clock = rng.randrange(10**6)
        for _ in range(rng.randint(1, 60)):
            clock += rng.choice([0, 1, 5, 20, 60])
            ms.append(clock - (rng.randrange(late) if late and rng.random() < 0.3 else 0))
            values.append(rng.choice([None, float("nan"), *[float(rng.randrange(20)) for _ in range(8)]]))
    low = [rng.choice([float("nan"), *[limits(rng) for _ in range(4)]]) for _ in ms]
    high = [rng.choice([float("nan"), *[limits(rng) for _ in range(4)]]) for _ in ms]
    bounds = [*starts, len(ms)]
    sets = []
    for begin, end in zip(bounds, bounds[1:], strict=False):
        held = []
        for i in range(begin, end):
            held = [j for j in [*held, i] if ms[j] >= ms[i] - window]
            sets.append(sorted(held, key=lambda j: (ms[j], j)))
    numbers = np.array([np.nan if v is None else v for v in values])
    made = Samples.of(np.array(ms), numbers, np.array([v is not None for v in values]), np.array(starts), 70)
    return made, values, np.array(low), np.array(high), sets, window


@pytest.mark.parametrize("late", [0, 20, 300])
@pytest.mark.parametrize("limits", [lambda r: float(r.randrange(3, 6)), lambda r: r.uniform(-1, 21)])
def test_figures_of_every_set(late, limits):
    for seed in range(25):
        samples, values, low, high, sets, window = sensors(seed, late, limits)
        found = trailing(samples, window)
        figures = limit_figures(samples, found, low, high, 0.167)
        last = samples.last()
        for i, held in enumerate(sets):
            assert found.count[i] == len(held) and found.first[i] == held[0] and last[i] == held[-1]
            steps = [
                (values[a], values[b])
                for a, b in zip(held, held[1:], strict=False)
                if values[a] is not None and values[b] is not None
            ]
            assert found.steps[i] == len(steps)
            assert found.rises[i] == sum(b > a for a, b in steps) and found.falls[i] == sum(b < a for a, b in steps)
            inside = [values[j] for j in held if values[j] is not None]
            assert figures["valued"][i] == len(inside)
            out = [v for v in inside if v < low[i] or v > high[i]]
            assert figures["breaches"][i] == len(out)
            assert np.isnan(figures["latest_breach"][i]) if not out else figures["latest_breach"][i] == out[-1]
            mean, sigma = (low[i] + high[i]) / 2.0, (high[i] - low[i]) * 0.167
            assert figures["far_above"][i] == sum(v > mean + sigma * 2 for v in inside)
            assert figures["some_below"][i] == sum(v < mean - sigma for v in inside)


def test_smaller_values_in_a_prefix():
    rng = np.random.default_rng(3)
    for size, most in ((0, 1), (1, 1), (200, 5), (1000, 700)):
        ranks = rng.integers(0, most + 1, size)
        prefix, x = rng.integers(0, size + 1, 300), rng.integers(0, most + 2, 300)
        found = Smaller(ranks, int(most + 1).bit_length()).count(prefix, x)
        assert found.tolist() == [int((ranks[:p] < v).sum()) for p, v in zip(prefix, x, strict=True)]


def test_few_and_many_limits_agree(monkeypatch):
    samples, _, low, high, _, window = sensors(5, 300, lambda r: float(r.randrange(20)))
    sets = trailing(samples, window)
    assert len(np.unique(high[~np.isnan(high)])) > FEW or len(high) < 40
    found = []
    for few in (0, 1000):
        monkeypatch.setattr("kilnwatch.operators.sample_sets.FEW", few)
        found.append((Beyond(samples, sets).counts(high), Beyond(samples, sets, -1).counts(low)))
    assert all((a == b).all() for a, b in zip(*found, strict=True))
