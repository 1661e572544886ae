"""Rule fixtures in list order, and random histories against the plain loop."""

from __future__ import annotations

import pytest
from fold import evaluate, random_readings, transitions
from helpers import evaluation_tuples, frame, from_fold, instant, reading, tidy

from kilnwatch.options import RuleOptions
from kilnwatch.operators.gate import batch_counts
from kilnwatch.operators.trailing import trailing_samples
from kilnwatch.operators.transitions import transitions as severity_changes
from kilnwatch.plans.alerts import alerts, evaluations

BASE = 1_749_686_400_000
LISTED = RuleOptions(limit_window_ms=10**9, trend_window_ms=10**9, min_batches=0)
SMALL = RuleOptions(
    limit_window_ms=20_000, trend_window_ms=8_000, min_batches=4, min_trend_samples=4,
    min_bias_samples=8, slice_ms=20_000,
)


def steady(value, count):
    return [value] * count


def ramp(first, last, count):
    return [first + (last - first) * i / (count - 1) for i in range(count)]


@pytest.mark.parametrize(
    "values, limits, rule, expected",
    [
        (steady(30.0, 237) + steady(32.0, 3), (29.0, 31.0), "NELSON_RULE_1", ("CRITICAL", "HIGH")),
        (steady(30.0, 238) + steady(27.0, 2), (29.0, 31.0), "NELSON_RULE_1", ("CAUTION", "LOW")),
        (ramp(29.0, 31.0, 50), (29.0, 31.0), "NELSON_RULE_3", ("CRITICAL", "TREND_UP")),
        (ramp(30.9, 29.3, 50), (29.0, 31.0), "NELSON_RULE_3", ("CAUTION", "TREND_DOWN")),
        (steady(30.0, 50), (29.0, 31.0), "NELSON_RULE_3", ("NORMAL", None)),
        (steady(30.8, 240), (29.0, 31.0), "BIAS_RATIO_RULE", ("CRITICAL", "BIAS_UP")),
        (steady(29.5, 240), (29.0, 31.0), "BIAS_RATIO_RULE", ("CAUTION", "BIAS_DOWN")),
        (steady(30.5, 240), (None, None), "BIAS_RATIO_RULE", ("NORMAL", None)),
        (steady(30.8, 239), (29.0, 31.0), "BIAS_RATIO_RULE", ("NORMAL", None)),
        (ramp(29.0, 31.0, 41), (29.0, 31.0), "NELSON_RULE_3", ("NORMAL", None)),
    ],
)
def test_listed_samples(spark, values, limits, rule, expected):
    rows = [
        reading(
            value=v, recipe_min=limits[0], recipe_max=limits[1],
            measured_at=instant(BASE + i * 1000), arrival_seq=i,
        )
        for i, v in enumerate(values)
    ]
    last = (
        evaluations(frame(spark, rows), LISTED)
        .filter(f"rule_name = '{rule}' and arrival_seq = {len(values) - 1}")
        .collect()
    )
    assert [(r.severity, r.anomaly_type, r.sample_count) for r in last] == [
        (*expected, len(values))
    ]


def test_reason_texts(spark):
    rows = [
        reading(value=v, measured_at=instant(BASE + i * 1000), arrival_seq=i)
        for i, v in enumerate([20.0, 31.0, 32.0, 33.5])
    ]
    options = RuleOptions(min_batches=0, min_trend_samples=4, min_bias_samples=4)
    texts = {
        r.rule_name: r.reason
        for r in evaluations(frame(spark, rows), options).filter("arrival_seq = 3").collect()
    }
    assert texts == {
        "NELSON_RULE_1": "최근 5분 내 Recipe 기준 이탈 3회 발생. 측정값 33.500 (기준 30.000)",
        "NELSON_RULE_3": "최근 1분 내 증가 추세 감지. 방향 비율 1.00, 변화율 67.50%",
        "BIAS_RATIO_RULE": "정상 범위 복구 (BIAS_RATIO_RULE)",
    }


@pytest.mark.parametrize("seed, slice_ms", [(1, 20_000), (2, 33_333), (3, 10_000_000)])
def test_random_history_in_order(spark, seed, slice_ms):
    rows = random_readings(seed, 600)
    options = RuleOptions(**{**SMALL.__dict__, "slice_ms": slice_ms})
    expected = evaluate(rows, options)
    readings = frame(spark, from_fold(rows)).cache()
    assert evaluation_tuples(evaluations(readings, options)) == tidy(expected)
    assert evaluation_tuples(alerts(readings, options)) == tidy(transitions(expected))
    kinds = {(row[3], row[4]) for row in expected}
    assert len(kinds) == 9, "every rule must reach every severity"


def test_window_bounds_and_ties(spark):
    times = [0, 0, 1, 60_000, 60_000, 60_001, 120_001]
    rows = [
        reading(measured_at=instant(BASE + t), arrival_seq=i, value=float(i))
        for i, t in enumerate(times)
    ]
    kept = trailing_samples(frame(spark, rows), 60_000, 60_000).orderBy("arrival_seq").collect()
    assert [(r.sample_count, r.first_value) for r in kept] == [
        (1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0), (5, 0.0), (4, 2.0), (2, 5.0),
    ]


def test_batch_counter_counts_changes(spark):
    batches = ["A", "B", None, "B", "A", None, None, "C", "C"]
    rows = [
        reading(batch_id=b, measured_at=instant(BASE + i * 1000), arrival_seq=i)
        for i, b in enumerate(batches)
    ]
    for slice_ms in (1000, 2500, 10**6):
        counted = batch_counts(frame(spark, rows), slice_ms).orderBy("arrival_seq").collect()
        assert [r.batch_count for r in counted] == [1, 2, 2, 2, 3, 3, 3, 4, 4]


def test_closed_gate_silences_only_its_rules(spark):
    rows = [
        reading(batch_id=f"b{i // 2}", measured_at=instant(BASE + i * 1000), arrival_seq=i)
        for i in range(12)
    ]
    found = alerts(frame(spark, rows), RuleOptions()).collect()
    assert sorted((r.arrival_seq, r.rule_name, r.severity) for r in found) == [
        (0, "NELSON_RULE_3", "NORMAL"),
        (8, "BIAS_RATIO_RULE", "NORMAL"),
        (8, "NELSON_RULE_1", "NORMAL"),
    ]


def test_transitions_of_given_evaluations(spark):
    severities = [None, "NORMAL", "NORMAL", "CRITICAL", "CRITICAL", None, None, "CAUTION"]
    rows = spark.createDataFrame(
        [(1, "S", "R", s, instant(BASE + i * 1000), i, 0) for i, s in enumerate(severities)],
        "equipment_id long, sensor_id string, rule_name string, severity string,"
        " detected_at timestamp, arrival_seq long, element_seq long",
    )
    for slice_ms in (1000, 3000, 10**6):
        kept = severity_changes(rows, slice_ms).orderBy("arrival_seq").collect()
        assert [r.arrival_seq for r in kept] == [1, 3, 5, 7]


def test_options_are_checked():
    with pytest.raises(ValueError):
        RuleOptions(slice_ms=1000)
    with pytest.raises(ValueError):
        RuleOptions(limit_window_ms=-1)
    assert RuleOptions().slice_length_ms == 1_800_000
