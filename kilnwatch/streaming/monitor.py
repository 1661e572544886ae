"""The anomaly rules on a stream: one stateful operator per sensor.

Readings are taken in the order they arrive. A late reading joins the sample sets and is
judged like any other; the sets keep the samples a later reading has not pushed out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kilnwatch.functions.reasons import reason
from kilnwatch.operators.projections import reading_events
from kilnwatch.operators.rules import (
    BIAS_SHARE,
    CRITICAL_BREACHES,
    NEAR_LIMIT_SHARE,
    SEVERITIES,
    SIGMA_OF_RANGE,
    TREND_CHANGE_PERCENT,
    TREND_SHARE,
)
from kilnwatch.operators.slices import KEY, MS, keyed
from kilnwatch.options import RuleOptions
from kilnwatch.schemas import (
    ARRIVAL,
    BIAS,
    BIAS_DOWN,
    BIAS_UP,
    CAUTION,
    CRITICAL,
    HIGH,
    LOW,
    NORMAL,
    RULE_1,
    RULE_3,
    TREND_DOWN,
    TREND_UP,
    VIOLATION,
)

_FINDING = T.StructType(
    [
        *[f for f in VIOLATION if f.name not in ("detected_at", "window_start", "window_end", "reason")],
        T.StructField("detected_ms", T.LongType()),
        T.StructField("start_ms", T.LongType()),
        T.StructField("evidence", T.DoubleType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("element_seq", T.LongType()),
        T.StructField("nans", T.IntegerType()),
    ]
)
#: Columns that may hold not-a-number, which pandas hands on as no value: ``nans`` has a bit for each.
_NUMBERS = ["measured_value", "reference_value", "deviation", "deviation_rate", "min", "max", "evidence"]

#: Readings of a sensor that are judged, and whose findings are handed on, at once.
READINGS_AT_ONCE = 1 << 13


def _before(flags: np.ndarray) -> np.ndarray:
    """Running count with a leading zero: entry ``i`` counts the flags before ``i``."""
    return np.concatenate(([0], np.cumsum(flags)))


class _Samples:
    """A trailing sample set, ordered by time and then arrival."""

    def __init__(self, window_ms: int, ms: list, values: list) -> None:
        self.window_ms = window_ms
        self.ms = np.array(ms, dtype=np.int64)
        self.values = np.array([np.nan if v is None else v for v in values], dtype=float)
        self.empty = np.array([v is None for v in values], dtype=bool)

    def add(self, ms: np.ndarray, values: np.ndarray, empty: np.ndarray):
        """Insert readings that are in order among themselves.

        Returns the first and last sample each of them sees. One late reading must come
        alone; it also sees the samples after it.
        """
        at = np.searchsorted(self.ms, ms, side="right")
        self.ms = np.insert(self.ms, at, ms)
        self.values = np.insert(self.values, at, values)
        self.empty = np.insert(self.empty, at, empty)
        first = np.searchsorted(self.ms, ms - self.window_ms, side="left")
        last = np.arange(len(self.ms) - len(ms), len(self.ms))
        return first, last

    def forget_before(self, first: int) -> None:
        self.ms, self.values, self.empty = (
            self.ms[first:], self.values[first:], self.empty[first:],
        )

    def stored(self) -> tuple[list, list]:
        values = [None if e else v for v, e in zip(self.values.tolist(), self.empty.tolist())]
        return self.ms.tolist(), values


def _judge_limits(samples: _Samples, first, last, low, high, min_bias: int):
    """Results of the limit and the bias rule for readings sharing one pair of limits."""
    value, empty = samples.values, samples.empty
    under = value < low if low is not None else np.zeros(len(value), bool)
    over = value > high if high is not None else np.zeros(len(value), bool)
    breach = under | over
    totals = _before(breach)
    breaches = totals[last + 1] - totals[first]
    latest = np.maximum.accumulate(np.where(breach, np.arange(len(value)), -1))[last]

    count = last - first + 1
    valued = _before(~empty)
    valued = valued[last + 1] - valued[first]
    shares = []
    if low is not None and high is not None and not high <= low:
        mean, sigma = (low + high) / 2.0, (high - low) * SIGMA_OF_RANGE
        for side, limit in (
            (BIAS_UP, mean + sigma * 2),
            (BIAS_DOWN, mean - sigma * 2),
            (BIAS_UP, mean + sigma),
            (BIAS_DOWN, mean - sigma),
        ):
            beyond = _before(value > limit if side == BIAS_UP else value < limit)
            beyond = beyond[last + 1] - beyond[first]
            share = beyond / np.maximum(valued, 1)
            hit = (count >= min_bias) & (valued > 0) & (share >= BIAS_SHARE)
            shares.append((side, CRITICAL if len(shares) < 2 else CAUTION, limit, share, hit))

    def limit_finding(i: int):
        if breaches[i] == 0:
            return None
        measured = float(value[latest[i]])
        is_high = high is not None and measured > high
        reference = high if is_high else low
        deviation = abs(measured - reference)
        rate = deviation / reference * 100.0 if reference != 0.0 else 0.0
        severity = CRITICAL if breaches[i] >= CRITICAL_BREACHES else CAUTION
        kind = HIGH if is_high else LOW
        return severity, kind, measured, reference, deviation, rate, float(breaches[i])

    def bias_finding(i: int):
        for side, severity, limit, share, hit in shares:
            if hit[i]:
                measured = None if empty[last[i]] else float(value[last[i]])
                deviation = None if measured is None else abs(measured - limit)
                return severity, side, measured, limit, deviation, float(share[i]) * 100.0, None
        return None

    severities = np.where(
        breaches == 0, NORMAL, np.where(breaches >= CRITICAL_BREACHES, CRITICAL, CAUTION)
    )
    bias = np.full(len(first), NORMAL, dtype=object)
    for _, severity, _, _, hit in reversed(shares):
        bias[hit] = severity
    return (severities, limit_finding), (bias, bias_finding)


def _judge_trend(samples: _Samples, first, last, low, high, min_samples: int):
    """Result of the trend rule for readings sharing one pair of limits."""
    value, empty = samples.values, samples.empty
    both = np.zeros(len(value), bool)
    both[1:] = ~(empty[1:] | empty[:-1])
    rise, fall = both.copy(), both.copy()
    rise[1:] &= value[1:] > value[:-1]
    fall[1:] &= value[1:] < value[:-1]

    def inside(flags):
        totals = _before(flags)
        return totals[last + 1] - totals[first + 1]

    steps = inside(both)
    rising, falling = (inside(f) / np.maximum(steps, 1) for f in (rise, fall))
    up, down = rising >= TREND_SHARE, falling >= TREND_SHARE
    start, end = value[first], value[last]
    with np.errstate(all="ignore"):
        change = np.abs((end - start) / start) * 100.0
        detected = (
            (last - first + 1 >= min_samples)
            & (steps > 0)
            & ~empty[first]
            & ~empty[last]
            & (start != 0.0)
            & (up | down)
            & ~(change < TREND_CHANGE_PERCENT)
        )
        near = np.zeros(len(first), bool)
        if low is not None and high is not None and not high - low <= 0.0:
            room = np.float64(high - low)
            position = np.where(up, (end - low) / room, (high - end) / room)
            near = position >= NEAR_LIMIT_SHARE
    severities = np.where(~detected, NORMAL, np.where(near, CRITICAL, CAUTION))

    def finding(i: int):
        if not detected[i]:
            return None
        measured, deviation = float(end[i]), float(abs(end[i] - start[i]))
        kind, reference, share = (
            (TREND_UP, high, rising[i]) if up[i] else (TREND_DOWN, low, falling[i])
        )
        return severities[i], kind, measured, reference, deviation, float(change[i]), float(share)

    return severities, finding


class SensorMonitor(StatefulProcessor):
    """Keeps a sensor's sample sets, batch count and last severities."""

    def __init__(self, options: RuleOptions, changes_only: bool, idle_ttl_ms: int | None) -> None:
        self.options = options
        self.changes_only = changes_only
        self.idle_ttl_ms = idle_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        sample_set = "ms array<bigint>, value array<double>"
        ttl = self.idle_ttl_ms
        self.limit_state = handle.getValueState("limit_samples", sample_set, ttl)
        self.trend_state = handle.getValueState("trend_samples", sample_set, ttl)
        self.batch_state = handle.getValueState("batches", "last string, total int", ttl)
        self.severity_state = handle.getValueState(
            "severities", "rule_1 string, bias string, rule_3 string", ttl
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        arrived = _Arrived(rows)
        limit = _Samples(self.options.limit_window_ms, *(self.limit_state.get() or ([], [])))
        trend = _Samples(self.options.trend_window_ms, *(self.trend_state.get() or ([], [])))
        batch, total = self.batch_state.get() or (None, 0)
        severities = dict(
            zip(SEVERITIES, self.severity_state.get() or (None, None, None))
        )
        newest = max([*limit.ms[-1:].tolist(), *trend.ms[-1:].tolist()], default=None)
        for given in arrived.stretches():
            batch, totals = _batch_totals(given["batch_id"].tolist(), batch, total)
            total = int(totals[-1])
            readings = _Readings(given, totals >= self.options.min_batches)
            found: list[tuple] = []
            for run in _ordered_runs(readings.ms, newest):
                self._judge(readings, run, limit, trend, severities, found)
            latest = int(readings.ms.max())
            newest = latest if newest is None else max(newest, latest)
            if found:
                yield readings.findings(found)
        self.limit_state.update(limit.stored())
        self.trend_state.update(trend.stored())
        self.batch_state.update((batch, total))
        self.severity_state.update(tuple(severities.values()))

    def _judge(self, readings: _Readings, run: slice, limit, trend, severities, found: list[tuple]) -> None:
        ms, values, empty = readings.ms[run], readings.values[run], readings.empty[run]
        limit_first, limit_last = limit.add(ms, values, empty)
        trend_first, trend_last = trend.add(ms, values, empty)
        gate_open = readings.gate_open[run]
        judged: list = [None] * len(ms)
        by_limits: dict = {}
        for i, pair in enumerate(readings.limits[run]):
            by_limits.setdefault(pair, []).append(i)
        for (low, high), members in by_limits.items():
            at = np.array(members)
            rule_1, bias = _judge_limits(
                limit, limit_first[at], limit_last[at], low, high, self.options.min_bias_samples
            )
            rule_3 = _judge_trend(
                trend, trend_first[at], trend_last[at], low, high, self.options.min_trend_samples
            )
            for place, i in enumerate(members):
                judged[i] = (place, rule_1, bias, rule_3)
        windows = {
            RULE_1: (limit, limit_first, limit_last),
            BIAS: (limit, limit_first, limit_last),
            RULE_3: (trend, trend_first, trend_last),
        }
        for i, (place, *results) in enumerate(judged):
            for rule, (levels, finding) in zip((RULE_1, BIAS, RULE_3), results, strict=True):
                if rule != RULE_3 and not gate_open[i]:
                    continue
                level = levels[place]
                if self.changes_only and severities[rule] == level:
                    continue
                severities[rule] = str(level)
                samples, first, last = windows[rule]
                result = finding(place)
                begin, end = int(first[i]), int(last[i])
                found.append((run.start + i, rule, result, int(samples.ms[begin]), end - begin + 1))
        limit.forget_before(limit_first[-1])
        trend.forget_before(trend_first[-1])

    def close(self) -> None:
        pass


def _batch_totals(batches: list, last, total: int):
    """The last known batch, and after each reading the number of changes of batch so far."""
    totals = np.empty(len(batches), np.int64)
    for i, batch in enumerate(batches):
        if batch is not None and batch == batch and batch != last:
            last, total = batch, total + 1
        totals[i] = total
    return last, totals


class _Arrived:
    """What one micro-batch brings a sensor, in numbers: columns as they come would take many times their room.

    Texts are kept once each, rows hold their numbers. Stretches of the readings, in order of arrival, are tables again.
    """

    def __init__(self, tables: Iterator[pd.DataFrame]) -> None:
        self.texts: dict[str, dict] = {}
        parts: dict[str, list[np.ndarray]] = {}
        for table in tables:
            for name in table.columns:
                column = table[name]
                number = pd.api.types.is_numeric_dtype(column)
                parts.setdefault(name, []).append(column.array if number else self._numbers(name, column))
        self.columns = {
            name: pd.concat([pd.Series(part, copy=False) for part in parts.pop(name)], ignore_index=True) for name in [*parts]
        }
        self.order = np.lexsort([self.columns[name].to_numpy(np.int64) for name in reversed(ARRIVAL)])

    def _numbers(self, name: str, column: pd.Series) -> np.ndarray:
        known = self.texts.setdefault(name, {})
        return np.array([known.setdefault(text, len(known)) for text in column.tolist()], dtype=np.int32)

    def stretches(self) -> Iterator[pd.DataFrame]:
        texts = {name: np.array([*known, None], dtype=object)[:-1] for name, known in self.texts.items()}
        for start in range(0, len(self.order), READINGS_AT_ONCE):
            at = self.order[start : start + READINGS_AT_ONCE]
            yield pd.DataFrame(
                {
                    name: texts[name][column.to_numpy()[at]] if name in texts else column.take(at).array
                    for name, column in self.columns.items()
                }
            )


class _Readings:
    """A sensor's readings of one micro-batch in order of arrival.

    Values and limits come with flags of their own: in a column of numbers no value looks like not-a-number.
    """

    def __init__(self, rows: pd.DataFrame, gate_open: np.ndarray) -> None:
        self.rows, self.gate_open = rows, gate_open
        self.ms = rows[MS].to_numpy(np.int64)
        self.empty = rows["no_value"].to_numpy(bool)
        self.values = np.where(self.empty, np.nan, rows["value"].to_numpy(float))
        low, high = (
            [None if none else v for none, v in zip(rows[f"no_{end}"].tolist(), rows[f"recipe_{end}"].tolist())]
            for end in ("min", "max")
        )
        self.limits = list(zip(low, high))

    def findings(self, found: list[tuple]) -> pd.DataFrame:
        """The rows of ``(reading, rule, result, start, count)``."""
        nothing = (NORMAL, None, None, None, None, None, None)
        at = [row[0] for row in found]
        results = [row[2] or nothing for row in found]
        severity, kind, measured, reference, deviation, rate, evidence = zip(*results)
        limits = [self.limits[row[0]] if row[2] else (None, None) for row in found]
        given = self.rows.iloc[at].reset_index(drop=True)
        columns = {
            "equipment_id": given["equipment_id"].astype("Int64"),
            "sensor_id": given["sensor_id"].tolist(),
            "sensor_type": given["sensor_type"].tolist(),
            "rule_name": [row[1] for row in found],
            "anomaly_type": kind,
            "severity": [str(s) for s in severity],
            "measured_value": pd.array(measured, object),
            "reference_value": pd.array(reference, object),
            "deviation": pd.array(deviation, object),
            "deviation_rate": pd.array(rate, object),
            "min": pd.array([low for low, _ in limits], object),
            "max": pd.array([high for _, high in limits], object),
            "sample_count": [row[4] for row in found],
            "detected_ms": self.ms[at],
            "start_ms": [row[3] for row in found],
            "evidence": pd.array(evidence, object),
            "arrival_seq": given["arrival_seq"].to_numpy(),
            "element_seq": given["element_seq"].to_numpy(),
        }
        columns["nans"] = sum(
            np.array([v is not None and v != v for v in columns[name]]).astype(np.int32) << bit
            for bit, name in enumerate(_NUMBERS)
        )
        return pd.DataFrame(columns)[_FINDING.fieldNames()]


def _ordered_runs(ms: np.ndarray, newest: int | None) -> Iterator[slice]:
    """Split arrivals into stretches without a late reading; each late one stands alone."""
    before = np.maximum.accumulate(np.concatenate([[ms[0] if newest is None else newest], ms[:-1]]))
    late = ms < before
    start = 0
    for place in np.flatnonzero(late).tolist():
        if place > start:
            yield slice(start, place)
        yield slice(place, place + 1)
        start = place + 1
    if start < len(ms):
        yield slice(start, len(ms))


def monitor(
    readings: DataFrame,
    options: RuleOptions = RuleOptions(),
    changes_only: bool = True,
    idle_ttl_ms: int | None = None,
) -> DataFrame:
    """Alerts of a reading stream, or every evaluation with ``changes_only=False``.

    Needs the RocksDB state store. ``idle_ttl_ms`` drops the state of sensors that went
    silent; by default it is kept, as a silent sensor's last severity still counts.
    """
    flags = {f"no_{name}": F.col(column).isNull() for name, column in
             (("value", "value"), ("min", "recipe_min"), ("max", "recipe_max"))}
    findings = (
        keyed(reading_events(readings))
        .drop("measured_at")
        .withColumns(flags)
        .groupBy(KEY)
        .transformWithStateInPandas(
            statefulProcessor=SensorMonitor(options, changes_only, idle_ttl_ms),
            outputStructType=_FINDING,
            outputMode="Append",
            timeMode="None" if idle_ttl_ms is None else "ProcessingTime",
        )
    )
    numbers = {
        name: F.when(F.col("nans").bitwiseAND(F.lit(1 << bit)) > 0, F.lit(float("nan"))).otherwise(F.col(name))
        for bit, name in enumerate(_NUMBERS)
    }
    return (
        findings.withColumns(numbers)
        .withColumns(
            {
                "detected_at": F.timestamp_millis("detected_ms"),
                "window_start": F.timestamp_millis("start_ms"),
                "window_end": F.timestamp_millis("detected_ms"),
                "reason": reason(),
            }
        )
        .select(*VIOLATION.fieldNames(), *ARRIVAL)
    )
