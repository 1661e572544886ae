"""Keys and path tokens derived from a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kilnwatch.functions.time import utc_date

UNKNOWN_DEVICE = "unknown"


def _or(column: Column, text: str) -> Column:
    return F.coalesce(column.cast("string"), F.lit(text))


def dedup_key() -> Column:
    """Identity of a reading inside its batch. A missing sequence reads ``null``."""
    return F.concat_ws(
        "|",
        _or(F.col("batch_id"), ""),
        _or(F.col("equipment_id"), ""),
        _or(F.col("sequence"), "null"),
        _or(F.col("sensor_id"), ""),
    )


def document_id(measured_at: Column | str = "measured_at") -> Column:
    """Identity of a reading in the latest-document table."""
    return F.concat_ws(
        "_",
        _or(F.col("equipment_id"), ""),
        _or(F.col("sensor_id"), ""),
        F.unix_millis(measured_at).cast("string"),
    )


def stream_key() -> Column:
    """The sensor a reading belongs to; never NULL, so equality joins keep every row."""
    return F.concat_ws(":", _or(F.col("equipment_id"), "null"), _or(F.col("sensor_id"), "null"))


def sanitize_token(raw: Column) -> Column:
    """C4: a device id that is safe as a single path component."""
    cleaned = F.regexp_replace(raw, r"[^A-Za-z0-9._\-]", "_")
    blank = raw.isNull() | raw.rlike(r"^[\s\x1c-\x1f\p{Z}&&[^\u00a0\u2007\u202f]]*$")
    return F.when(blank | cleaned.rlike(r"^\.*$"), F.lit(UNKNOWN_DEVICE)).otherwise(cleaned)


def bucket_path(created_at: Column, device_id: Column) -> Column:
    """``yyyy/MM/dd/device`` from the UTC creation day."""
    day = F.replace(utc_date(created_at).cast("string"), F.lit("-"), F.lit("/"))
    return F.concat_ws("/", day, sanitize_token(device_id))


def idempotency_key(scope: str = "event") -> Column:
    """Delivery key of an alert.

    ``scope="event"`` names equipment, sensor type, severity and time, so alerts of two
    rules at one instant share a key. ``scope="full"`` adds the sensor and the rule.
    """
    parts = [
        _or(F.col("equipment_id"), "null"),
        _or(F.col("sensor_type"), "null"),
        _or(F.col("severity"), "RECOVERY"),
        F.unix_millis("detected_at").cast("string"),
    ]
    if scope == "full":
        parts += [_or(F.col("sensor_id"), "null"), _or(F.col("rule_name"), "null")]
    elif scope != "event":
        raise ValueError(f"unknown key scope {scope!r}")
    return F.concat_ws(":", *parts)
