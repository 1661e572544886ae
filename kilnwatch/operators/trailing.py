"""Trailing event-time sample sets (E3, E4, E6, H1, H3) in linear time.

The set of a reading holds every sample of its sensor from ``window_ms`` before it
(inclusive) up to itself, in order of event time and then arrival. Each sample
appears twice in one ordered sequence: when it enters, and right after the last reading
that still sees it. Running sums over that sequence then give counts for every reading
at constant cost per row, however many samples a window holds.

The sequence is cut into stretches of time far shorter than a window, and a task holds
whole stretches only. A leave stands in the stretch of its own moment. What a stretch
takes over from earlier ones (sums, the first sample still kept) is worked out beforehand
from one row per stretch, and joins the sequence as its first row.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatch.operators.projections import reading_events
from kilnwatch.operators.slices import (
    KEY,
    MS,
    SAMPLE_ORDER,
    SLICE,
    SLICE_KEYS,
    dealt,
    keyed,
    slice_of,
    with_slices,
)
from kilnwatch.schemas import ARRIVAL
from kilnwatch.session import written

MOMENT, ROLE, PLACE = "moment_ms", "role", "place"
#: Tallies travel as the bits of one INT.
MOST_TALLIES = 31
#: Roles of the rows of a sequence; leaves are counted from 1, a number for each window.
TAKES_OVER, JOINS, ENTERS = -2, -1, 0
LAST_PLACE = 2**31 - 1
#: Stretches of a slice, at least.
STRETCHES = 16
#: Samples of one sensor in a stretch, beyond which stretches are made shorter, and the least on average for that.
MOST_IN_STRETCH, FEWEST_IN_STRETCH = 1 << 12, 1 << 8


@dataclass(frozen=True)
class Tally:
    """A count over one window: what a sample adds, and what its leaving takes away.

    One with ``leaving`` counts steps, from the sample before and to the one after. Its
    flags are 0 where that neighbour is missing.
    """

    window: str
    entering: Column
    leaving: Column | None = None


def sliced_samples(readings: DataFrame, window_ms: int, slice_ms: int) -> DataFrame:
    """Reading events per (sensor, slice), with the lead-in each slice looks back to."""
    return with_slices(keyed(reading_events(readings)), slice_ms, window_ms)


def stretch_length(slice_ms: int) -> int:
    return max(1, -(-slice_ms // STRETCHES))


def stretched_samples(readings: DataFrame, stretch_ms: int) -> DataFrame:
    """Reading events per (sensor, stretch), none of them twice."""
    return with_slices(keyed(reading_events(readings)), stretch_ms).where(F.col(MS).isNotNull())


def spread(readings: DataFrame, slice_ms: int) -> tuple[int, int]:
    """The length of a stretch, and the number of samples.

    Stretches get shorter where the fullest one holds too many samples, but not so short that
    the rows kept for each stretch come near the number of samples.
    """
    stretch_ms = stretch_length(slice_ms)
    counts = stretched_samples(readings, stretch_ms).groupBy(*SLICE_KEYS).count()
    stretches, samples, most = counts.agg(F.count("*"), F.sum("count"), F.max("count")).first()
    if not stretches:
        return stretch_ms, 0
    pieces = min(-(-most // MOST_IN_STRETCH), samples // (stretches * FEWEST_IN_STRETCH))
    return max(1, stretch_ms // max(1, pieces)), samples


def _bits(flags: dict[int, Column]) -> Column:
    total = F.lit(0)
    for place, flag in flags.items():
        total = total + F.shiftleft(flag, place)
    return total


def sweep(
    samples: DataFrame,
    windows: Mapping[str, int],
    tallies: Mapping[str, Tally],
    stretch_ms: int,
    latest: Mapping[str, Column] | None = None,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """Evaluate all windows of every sample in one ordered pass per stretch.

    Adds, per window, ``<window>_count`` and ``<window>_first`` (time and value of the
    earliest sample kept), one column per tally, and one per ``latest`` entry: its last
    non-NULL value so far. ``within`` names further columns that split a sensor.

    Tests run once per sample, before it is doubled, and travel as the bits of one
    number. That keeps the rows narrow and each generated method small enough for the
    JVM to compile. The tested samples are kept as a table, as sums and sequence read them.
    """
    latest = latest or {}
    tallies = {
        **tallies,
        **{f"{name}_count": Tally(name, F.lit(1)) for name in windows},
    }
    if len(tallies) > MOST_TALLIES:
        raise ValueError(f"a sweep carries at most {MOST_TALLIES} tallies")
    group = [*SLICE_KEYS, *within]
    carried = [c for c in samples.columns if c not in (*group, MS)]
    tested = written(_tested(samples, windows, tallies, latest, group, carried), "samples")
    joints = written(_joints(tested, within), "joints")
    moments = _moments(tested, windows, stretch_ms, group).unionByName(
        _joining(joints, windows, tallies, stretch_ms, within), allowMissingColumns=True
    )
    taken_over = written(_taken_over(tested, moments, windows, tallies, latest, stretch_ms, within), "sums")
    opening = taken_over.select(
        *group,
        F.col(SLICE).alias(MOMENT),
        F.lit(TAKES_OVER).alias(ROLE),
        F.lit(0).alias(PLACE),
        F.lit(0).alias("bits"),
        F.struct(*[c for c in taken_over.columns if c not in group]).alias("earlier"),
    )
    sequence = dealt(moments.unionByName(opening, allowMissingColumns=True), tested.count())
    so_far = (
        Window.partitionBy(*group)
        .orderBy(MOMENT, ROLE, PLACE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = {name: F.sum(_change(place)).over(so_far) for place, name in enumerate(tallies)}
    for name, number in _roles(windows).items():
        inside[f"{name}_first"] = F.last(
            F.when(F.col(ROLE) == number, F.col("following")), ignorenulls=True
        ).over(so_far)
    inside["_opened"] = F.first("sample", ignorenulls=True).over(so_far)
    inside["_earlier"] = F.first("earlier").over(so_far)
    summed = sequence.withColumns(inside).filter(F.col(ROLE) == ENTERS)
    columns = [
        (F.col(name) + F.coalesce(f"_earlier.{name}", F.lit(0))).alias(name) for name in tallies
    ]
    columns += [
        F.coalesce(f"{name}_first", f"_earlier.{name}_first", "_earlier.sample", "_opened").alias(f"{name}_first")
        for name in windows
    ]
    columns += [F.coalesce(f"reading.{name}", f"_earlier.{name}").alias(name) for name in latest]
    return summed.select(
        *group, F.col(MOMENT).alias(MS), *columns, *[f"reading.{c}" for c in carried]
    )


def _roles(windows: Mapping[str, int]) -> dict[str, int]:
    return {name: role for role, name in enumerate(windows, start=1)}


def _change(place: int) -> Column:
    """What a row of the sequence adds to the tally of this place."""
    sign = F.when(F.col(ROLE) <= ENTERS, F.lit(1)).otherwise(F.lit(-1))
    return F.shiftright("bits", place).bitwiseAND(F.lit(1)) * sign


def _tested(samples, windows, tallies, latest, group: list[str], carried: list[str]) -> DataFrame:
    """Samples with their flags, the neighbour after and the place in their stretch, which settles ties."""
    order = Window.partitionBy(*group).orderBy(*SAMPLE_ORDER)
    placed = samples.withColumns(
        {
            "previous_value": F.lag("value").over(order),
            "next_value": F.lead("value").over(order),
            "next_ms": F.lead(MS).over(order),
            PLACE: F.row_number().over(order),
            **{
                name: F.last(value, ignorenulls=True).over(
                    order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
                )
                for name, value in latest.items()
            },
        }
    )
    places = {name: place for place, name in enumerate(tallies)}
    losses = {
        window: _bits(
            {
                places[n]: t.entering if t.leaving is None else t.leaving
                for n, t in tallies.items()
                if t.window == window
            }
        )
        for window in windows
    }
    return placed.select(
        *group,
        MS,
        PLACE,
        "value",
        "next_ms",
        "next_value",
        _bits({places[n]: t.entering for n, t in tallies.items()}).alias("gains"),
        *[flags.alias(f"{window}_losses") for window, flags in losses.items()],
        F.struct(*carried, *latest).alias("reading"),
    )


def _joints(tested: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """The last sample of each stretch with the first of the next one that has any."""
    outer = tested.where((F.col(PLACE) == 1) | F.col("next_ms").isNull())
    order = Window.partitionBy(KEY, *within).orderBy(SLICE, PLACE)
    return (
        outer.select(
            *SLICE_KEYS, *within, MS, "value", "next_ms",
            F.lead(SLICE).over(order).alias("after_slice"),
            F.lead(MS).over(order).alias("after_ms"),
            F.lead("value").over(order).alias("after_value"),
        )
        .where(F.col("next_ms").isNull() & F.col("after_ms").isNotNull())
        .drop("next_ms")
    )


def _moments(tested: DataFrame, windows: Mapping[str, int], stretch_ms: int, group: list[str]) -> DataFrame:
    """Each sample as it enters, and as it leaves each window."""

    def moment(at: Column, role: int, flags: str, **parts: Column) -> Column:
        nothing = F.lit(None)
        kept = {
            "sample": F.struct(F.col(MS).alias("ms"), F.col("value").alias("value")),
            "following": F.struct(F.col("next_ms").alias("ms"), F.col("next_value").alias("value")),
            "reading": F.col("reading"),
        }
        wanted = {
            "sample": F.lit(role == ENTERS), "reading": F.lit(role == ENTERS),
            "following": F.lit(role != ENTERS) & F.col("next_ms").isNotNull(),
        }
        return F.struct(
            slice_of(at, stretch_ms).alias(SLICE),
            at.alias(MOMENT),
            F.lit(role).alias(ROLE),
            F.col(flags).alias("bits"),
            *[F.when(wanted[name], part).otherwise(nothing).alias(name) for name, part in kept.items()],
        )

    rows = [moment(F.col(MS), ENTERS, "gains")] + [
        moment(F.col(MS) + F.lit(windows[name]), number, f"{name}_losses")
        for name, number in _roles(windows).items()
    ]
    others = [c for c in group if c != SLICE]
    return tested.select(*others, PLACE, F.inline(F.array(*rows)))


def _joining(joints: DataFrame, windows, tallies: Mapping[str, Tally], stretch_ms: int, within) -> DataFrame:
    """The steps between stretches, which come with the later sample's stretch and go with the earlier sample."""
    steps = {name: (place, t) for place, (name, t) in enumerate(tallies.items()) if t.leaving is not None}
    nothing = F.lit(None).cast("double")

    def row(pairs: DataFrame, at: Column, role: int, place: int, flags: Column, *following: Column) -> DataFrame:
        return pairs.select(
            KEY, *within,
            F.lit(place).alias(PLACE),
            slice_of(at, stretch_ms).alias(SLICE),
            at.alias(MOMENT),
            F.lit(role).alias(ROLE),
            flags.alias("bits"),
            *[f.alias("following") for f in following],
        )

    coming = joints.withColumns({"previous_value": F.col("value"), "value": F.col("after_value"), "next_value": nothing})
    going = joints.withColumns({"previous_value": nothing, "next_value": F.col("after_value")})
    after = F.struct(F.col("after_ms").alias("ms"), F.col("after_value").alias("value"))
    rows = [row(coming, F.col("after_slice"), JOINS, 0, _bits({p: t.entering for p, t in steps.values()}), F.lit(None))]
    for name, number in _roles(windows).items():
        lost = _bits({p: t.leaving for p, t in steps.values() if t.window == name})
        rows.append(row(going, F.col(MS) + F.lit(windows[name]), number, LAST_PLACE, lost, after))
    return reduce(DataFrame.unionByName, rows)


def _taken_over(tested, moments, windows, tallies, latest, stretch_ms: int, within) -> DataFrame:
    """What each stretch with samples takes over from all earlier ones of its sensor.

    Only one row per stretch is put in order by sensor.
    """
    group = [*SLICE_KEYS, *within]
    sums = moments.groupBy(*group).agg(*[F.sum(_change(place)).alias(name) for place, name in enumerate(tallies)])
    # The last leave of a stretch tells the first sample kept at its end.
    handed = []
    others = [c for c in group if c != SLICE]
    for name, number in _roles(windows).items():
        leave, next_leave = (F.col(c) + F.lit(windows[name]) for c in (MS, "next_ms"))
        inner = tested.where(slice_of(leave, stretch_ms) != slice_of(next_leave, stretch_ms)).select(
            *others,
            slice_of(leave, stretch_ms).alias(SLICE),
            F.struct(
                leave.alias("at"), F.col(PLACE).alias("place"),
                F.struct(F.col("next_ms").alias("ms"), F.col("next_value").alias("value")).alias("first"),
            ).alias(f"{name}_first"),
        )
        outer = moments.where((F.col(ROLE) == number) & (F.col(PLACE) == LAST_PLACE)).select(
            *group,
            F.struct(F.col(MOMENT).alias("at"), F.col(PLACE).alias("place"), F.col("following").alias("first")).alias(
                f"{name}_first"
            ),
        )
        handed.append(inner.unionByName(outer))
    opened = tested.where(F.col(PLACE) == 1).select(
        *group, F.struct(F.col(MS).alias("ms"), F.col("value").alias("value")).alias("sample")
    )
    closed = tested.where(F.col("next_ms").isNull()).select(*group, *[F.col(f"reading.{n}").alias(n) for n in latest])
    parts = [sums, *handed, opened, closed]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    firsts = [f"{name}_first" for name in windows]
    stretches = every.groupBy(*group).agg(
        *[F.max(name).alias(name) for name in (*tallies, *firsts)],
        *[F.first(name, ignorenulls=True).alias(name) for name in ("sample", *latest)],
    )
    before = Window.partitionBy(KEY, *within).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        stretches.select(
            *group,
            F.col("sample").isNotNull().alias("_asked"),
            *[F.sum(name).over(before).alias(name) for name in tallies],
            *[F.last(f"{name}.first", ignorenulls=True).over(before).alias(name) for name in firsts],
            F.first("sample", ignorenulls=True).over(before).alias("sample"),
            *[F.last(name, ignorenulls=True).over(before).alias(name) for name in latest],
        )
        .where(F.col("_asked") & F.col("sample").isNotNull())
        .drop("_asked")
    )


def trailing_samples(readings: DataFrame, window_ms: int, slice_ms: int | None = None) -> DataFrame:
    """Count, bounds and outer values of each reading's trailing set."""
    stretch_ms, count = spread(readings, slice_ms or max(1, 6 * window_ms))
    swept = sweep(dealt(stretched_samples(readings, stretch_ms), count), {"kept": window_ms}, {}, stretch_ms)
    return swept.select(
        "equipment_id",
        "sensor_id",
        "measured_at",
        *ARRIVAL,
        F.timestamp_millis("kept_first.ms").alias("window_start"),
        F.col("measured_at").alias("window_end"),
        F.col("kept_count").cast("int").alias("sample_count"),
        F.col("kept_first.value").alias("first_value"),
        F.col("value").alias("last_value"),
    )
