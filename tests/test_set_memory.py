"""Room that the figures of limits of each reading's own take."""

from __future__ import annotations

import tracemalloc

import numpy as np

from kilnwatch.operators.sample_sets import Samples, limit_figures, trailing


def test_room_for_a_sample():
    count, window = 200_000, 100_000
    rng = np.random.default_rng(5)
    ms, values = np.sort(rng.integers(0, 2 * window, count)), rng.normal(50, 30, count)
    low, high = rng.random(count) * 20, 100 - rng.random(count) * 20
    tracemalloc.start()
    try:
        samples = Samples.of(ms, values, np.ones(count, bool), np.array([0]), window)
        limit_figures(samples, trailing(samples, window), low, high, 0.167)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 700 * count
