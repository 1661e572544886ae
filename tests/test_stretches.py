"""The stream's monitor hands on what it finds stretch by stretch."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from kilnwatch.options import RuleOptions
from kilnwatch.streaming import monitor as M


class State:
    """One value, as the state store keeps it."""

    def __init__(self):
        self.value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class Handle:
    def __init__(self):
        self.states: dict[str, State] = {}

    def getValueState(self, name, *_):
        return self.states.setdefault(name, State())


def readings(count: int) -> pd.DataFrame:
    rng = np.random.default_rng(7)
    ms = np.cumsum(rng.integers(0, 40, count))
    ms[rng.integers(1, count, count // 30)] -= 500
    value = rng.normal(50, 30, count).round(1)
    return pd.DataFrame(
        {
            "equipment_id": 1, "sensor_id": "S", "sensor_type": [None if i % 7 == 0 else "T" for i in range(count)],
            "batch_id": [None if i % 11 == 0 else f"B{i // 25}" for i in range(count)],
            "value": np.where(rng.random(count) < 0.05, np.nan, value), "recipe_min": 10.0, "recipe_max": 90.0,
            "ms": ms, "arrival_seq": np.arange(count), "element_seq": 0,
            "no_value": False, "no_min": False, "no_max": False,
        }
    ).assign(no_value=lambda rows: rows["value"].isna()).sample(frac=1, random_state=3)


def monitored(tables: list[list[pd.DataFrame]], at_once: int, monkeypatch):
    monkeypatch.setattr(M, "READINGS_AT_ONCE", at_once, raising=False)
    options = RuleOptions(limit_window_ms=2000, trend_window_ms=500, min_batches=3, min_trend_samples=5, min_bias_samples=20)
    handle, found = Handle(), []
    for batch in tables:
        processor = M.SensorMonitor(options, False, None)
        processor.init(handle)
        found += list(processor.handleInputRows(("1:S",), iter(batch), None))
    return found, {name: state.value for name, state in handle.states.items()}


@pytest.mark.parametrize("at_once", [1, 16, 400])
def test_stretches_find_the_same(monkeypatch, at_once):
    rows = readings(400)
    early, late = rows[rows["arrival_seq"] < 250], rows[rows["arrival_seq"] >= 250]
    tables = [[early[:90], early[90:]], [late]]
    whole, state = monitored(tables, 1 << 20, monkeypatch)
    parts, same_state = monitored(tables, at_once, monkeypatch)
    pd.testing.assert_frame_equal(pd.concat(whole, ignore_index=True), pd.concat(parts, ignore_index=True), check_dtype=False)
    assert repr(state) == repr(same_state)
    assert max(map(len, parts)) <= 3 * at_once
