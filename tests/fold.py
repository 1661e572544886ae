"""The rules as a plain loop over one sensor's readings in order of arrival.

Slow and literal; the yardstick for the batch plans and the stream.
"""

from __future__ import annotations

import random


def evaluate(readings: list[dict], options) -> list[tuple]:
    """All evaluations: (arrival, rule, severity, type, measured, reference, deviation,
    rate, window start, count)."""
    found: list[tuple] = []
    sensors: dict = {}
    for reading in sorted(readings, key=lambda r: r["arrival_seq"]):
        key = (reading["equipment_id"], reading["sensor_id"])
        state = sensors.setdefault(key, {"limit": [], "trend": [], "batch": None, "total": 0})
        batch = reading["batch_id"]
        if batch is not None and batch != state["batch"]:
            state["batch"], state["total"] = batch, state["total"] + 1
        sets = {}
        for name, window in (
            ("limit", options.limit_window_ms),
            ("trend", options.trend_window_ms),
        ):
            kept = [s for s in [*state[name], reading] if s["ms"] >= reading["ms"] - window]
            state[name] = kept
            sets[name] = sorted(kept, key=lambda s: s["ms"])
        low, high = reading["recipe_min"], reading["recipe_max"]
        results = []
        if state["total"] >= options.min_batches:
            results.append(("NELSON_RULE_1", limit_rule(sets["limit"], low, high), "limit"))
            results.append(
                ("BIAS_RATIO_RULE", bias_rule(sets["limit"], low, high, options), "limit")
            )
        results.append(("NELSON_RULE_3", trend_rule(sets["trend"], low, high, options), "trend"))
        for rule, result, name in results:
            figures = result or ("NORMAL", None, None, None, None, None)
            found.append(
                (reading["arrival_seq"], *key, rule, *figures, sets[name][0]["ms"], len(sets[name]))
            )
    return found


def transitions(evaluations: list[tuple]) -> list[tuple]:
    last: dict = {}
    changed = []
    for row in evaluations:
        if last.get(row[1:4]) != row[4]:
            last[row[1:4]] = row[4]
            changed.append(row)
    return changed


def limit_rule(samples, low, high):
    out = [
        s["value"]
        for s in samples
        if s["value"] is not None
        and ((low is not None and s["value"] < low) or (high is not None and s["value"] > high))
    ]
    if not out:
        return None
    value = out[-1]
    over = high is not None and value > high
    reference = high if over else low
    gap = abs(value - reference)
    rate = gap / reference * 100.0 if reference != 0.0 else 0.0
    return "CRITICAL" if len(out) >= 3 else "CAUTION", "HIGH" if over else "LOW", value, reference, gap, rate


def trend_rule(samples, low, high, options):
    if len(samples) < options.min_trend_samples:
        return None
    values = [s["value"] for s in samples]
    pairs = [(a, b) for a, b in zip(values, values[1:]) if a is not None and b is not None]
    if not pairs or values[0] is None or values[-1] is None or values[0] == 0.0:
        return None
    rising = sum(b > a for a, b in pairs) / len(pairs)
    falling = sum(b < a for a, b in pairs) / len(pairs)
    change = abs((values[-1] - values[0]) / values[0]) * 100.0
    if not (rising >= 0.7 or falling >= 0.7) or change < 5.0:
        return None
    up = rising >= 0.7
    near = False
    if low is not None and high is not None and not high - low <= 0.0:
        run = values[-1] - low if up else high - values[-1]
        near = run / (high - low) >= 0.9
    return (
        "CRITICAL" if near else "CAUTION", "TREND_UP" if up else "TREND_DOWN",
        values[-1], high if up else low, abs(values[-1] - values[0]), change,
    )


def bias_rule(samples, low, high, options):
    if len(samples) < options.min_bias_samples or low is None or high is None or high <= low:
        return None
    mean, sigma = (low + high) / 2.0, (high - low) * 0.167
    values = [s["value"] for s in samples if s["value"] is not None]
    if not values:
        return None
    last = samples[-1]["value"]
    for severity, kind, limit in (
        ("CRITICAL", "BIAS_UP", mean + sigma * 2),
        ("CRITICAL", "BIAS_DOWN", mean - sigma * 2),
        ("CAUTION", "BIAS_UP", mean + sigma),
        ("CAUTION", "BIAS_DOWN", mean - sigma),
    ):
        hits = sum(v > limit if kind == "BIAS_UP" else v < limit for v in values)
        if hits / len(values) >= 0.8:
            gap = None if last is None else abs(last - limit)
            return severity, kind, last, limit, gap, hits / len(values) * 100.0
    return None


def random_readings(seed: int, count: int, disorder_ms: int = 0) -> list[dict]:
    """Drifting values with ties, gaps, missing values and shifting limits."""
    rng = random.Random(seed)
    clock, level, rows = 1_700_000_000_000, 20.0, []
    for arrival in range(count):
        clock += rng.choice([0, 0, 1, 40, 250, 900, 2500])
        if rng.random() < 0.01:
            clock += 120_000
        level += rng.choice([-1.0, 0.0, 0.5, 1.0]) if arrival % 90 < 50 else rng.choice([-1.5, 0.5])
        level = min(max(level, 0.0), 45.0)
        roll = rng.random()
        value = None if roll < 0.04 else float("nan") if roll < 0.06 else level
        shifted = arrival % 130 < 40
        rows.append(
            {
                "arrival_seq": arrival,
                "equipment_id": rng.choice([1, 1, 1, None]),
                "sensor_id": rng.choice(["a", "a", "a", None]),
                "batch_id": None if rng.random() < 0.2 else f"b{arrival // 15}",
                "value": value,
                "recipe_min": None if rng.random() < 0.02 else 12.0 if shifted else 10.0,
                "recipe_max": 5.0 if rng.random() < 0.02 else 26.0 if shifted else 30.0,
                "ms": clock - (rng.randrange(disorder_ms) if rng.random() < 0.15 and disorder_ms else 0),
            }
        )
    return rows


def same(value):
    """A NaN that equals itself."""
    return "NaN" if isinstance(value, float) and value != value else value
