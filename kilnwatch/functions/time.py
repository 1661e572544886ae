"""Instants as whole milliseconds, and their texts in UTC whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def whole_millis(ts: Column) -> Column:
    """The instant with anything below a millisecond cut off."""
    return F.timestamp_millis(F.unix_millis(ts))


def utc_instant(wall_clock: Column) -> Column:
    """A zone-less timestamp read as a UTC wall clock."""
    here = F.convert_timezone(F.lit("UTC"), F.current_timezone(), wall_clock)
    return here.cast("timestamp")


def utc_date(ts: Column) -> Column:
    """The UTC calendar day of an instant."""
    ms = F.unix_millis(ts)
    days = (ms - F.pmod(ms, F.lit(DAY_MS))) / F.lit(DAY_MS)
    return F.date_from_unix_date(days.cast("int"))


def iso_instant(ts: Column) -> Column:
    """``2026-06-14T00:15:26Z``, with three or six fraction digits where needed."""
    micros = F.unix_micros(ts)
    fraction = F.pmod(micros, F.lit(1_000_000)).cast("int")
    second = F.pmod(F.unix_seconds(ts), F.lit(86_400)).cast("int")
    clock = F.format_string(
        "%02d:%02d:%02d",
        (second / F.lit(3600)).cast("int"),
        (F.pmod(second, F.lit(3600)) / F.lit(60)).cast("int"),
        F.pmod(second, F.lit(60)),
    )
    digits = (
        F.when(fraction == 0, F.lit(""))
        .when(
            F.pmod(fraction, F.lit(1000)) == 0,
            F.format_string(".%03d", (fraction / F.lit(1000)).cast("int")),
        )
        .otherwise(F.format_string(".%06d", fraction))
    )
    text = F.concat(utc_date(ts).cast("string"), F.lit("T"), clock, digits, F.lit("Z"))
    return F.when(ts.isNotNull(), text)
