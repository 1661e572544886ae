from __future__ import annotations

import datetime as dt

from fold import same

from kilnwatch.schemas import READING

UTC = dt.timezone.utc


def instant(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(0, UTC) + dt.timedelta(milliseconds=ms)


def reading(**given) -> dict:
    row = dict.fromkeys(READING.fieldNames())
    row |= {
        "batch_id": "B", "device_id": "D", "equipment_id": 1, "created_at": instant(1000),
        "interval_sec": 5, "sequence": 2, "measured_at": instant(2000),
        "measurement_status": "OK", "sensor_id": "S1", "sensor_type": "TEMP", "value": 21.5,
        "recipe_min": 10.0, "recipe_max": 30.0, "unit": "C", "sensor_status": "OK",
        "arrival_seq": 0, "element_seq": 0,
    }
    return row | given


def frame(spark, rows: list[dict]):
    ordered = [tuple(row[name] for name in READING.fieldNames()) for row in rows]
    return spark.createDataFrame(ordered, READING)


def from_fold(rows: list[dict]) -> list[dict]:
    return [
        reading(
            **{k: v for k, v in row.items() if k != "ms"},
            measured_at=instant(row["ms"]), created_at=instant(row["ms"]),
        )
        for row in rows
    ]


def evaluation_tuples(df) -> list[tuple]:
    """Evaluations in the layout of :mod:`fold`, sorted."""
    rows = df.selectExpr(
        "arrival_seq", "equipment_id", "sensor_id", "rule_name", "severity", "anomaly_type",
        "measured_value", "reference_value", "deviation", "deviation_rate",
        "unix_millis(window_start)", "sample_count",
    ).collect()
    return tidy(rows)


def tidy(rows) -> list[tuple]:
    return sorted((tuple(map(same, row)) for row in rows), key=lambda row: (row[0], row[3]))
