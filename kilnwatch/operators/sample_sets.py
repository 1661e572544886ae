"""Figures of trailing sample sets, for many sensors at once (numpy only; it runs where the samples are).

Samples come in the order of arrival. The set of a sample holds what arrived before it, less what a later arrival, more
than a window ahead of it, has pushed out for good; so a set is cut at its early end and grows anywhere. A sample is
therefore in the sets of one stretch of arrivals: from its own up to the first one more than a window ahead, its leave.

* A count over a set is a count over what arrived less a count over what left. With few different limits both are running
  sums of a test; with limits of each reading's own they are counts of smaller values in a prefix, answered for all
  readings by a wavelet matrix in as many steps as ranks have bits. No sample is copied for a limit.
* Sensors whose samples arrived in order are worked out by searches in sorted arrays. The others' sets are kept as
  sorted lists, one sample at a time, which also tells what stands next to each other when.
"""

from __future__ import annotations

import sys
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value

#: Up to so many different limits are tested one by one.
FEW = 16
#: So many counts are worked out, and so many samples walked through, at once; an array of a task takes no more for it.
ASKED_AT_ONCE = 1 << 16


@dataclass
class Samples:
    """Samples of several sensors, one sensor after the other, each in order of arrival.

    ``at`` are times moved so that each sensor's first sample lies more than ``reach`` after the sensor before.
    """

    at: np.ndarray
    values: np.ndarray
    valued: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, ms: np.ndarray, values: np.ndarray, valued: np.ndarray, starts: np.ndarray, reach: int) -> Samples:
        least, most = np.minimum.reduceat(ms, starts), np.maximum.reduceat(ms, starts)
        spans = most - least + (reach + 1)
        moved = np.cumsum(spans) - spans - least
        sizes = np.diff(np.append(starts, len(ms)))
        return cls(ms + np.repeat(moved, sizes), np.where(valued, values, np.nan), valued, starts)

    def __post_init__(self):
        count = len(self.at)
        self.order = np.argsort(self.at, kind="stable")
        self.place = np.empty(count, np.int64)
        self.place[self.order] = np.arange(count)
        self.peak = np.maximum.accumulate(self.at)

    def unordered(self) -> list[tuple[int, int]]:
        """The stretches of sensors with a sample that arrived after a later one."""
        late = np.flatnonzero(self.at < self.peak)
        ends = np.append(self.starts[1:], len(self.at))
        which = np.unique(np.searchsorted(self.starts, late, side="right") - 1)
        return [(int(self.starts[k]), int(ends[k])) for k in which]

    def last(self) -> np.ndarray:
        """The latest sample of each set: its sensor's latest so far."""
        return self.order[np.maximum.accumulate(self.place)]


@dataclass
class Sets:
    """Of each sample: its leave, the first sample of its set, the set's size and steps, and how many samples have left."""

    leave: np.ndarray
    first: np.ndarray
    count: np.ndarray
    left: np.ndarray
    rises: np.ndarray
    falls: np.ndarray
    steps: np.ndarray


def trailing(samples: Samples, window: int) -> Sets:
    at, values = samples.at, samples.values
    count = len(at)
    leave = np.searchsorted(samples.peak, at + window, side="right")
    first = np.searchsorted(samples.peak, at - window, side="left")
    here = np.arange(count)
    both = np.zeros(count, bool)
    both[1:] = samples.valued[1:] & samples.valued[:-1]
    tallies = []
    for flag in (np.append(False, values[1:] > values[:-1]), np.append(False, values[1:] < values[:-1]), both):
        so_far = np.concatenate([[0], np.cumsum(flag)])
        # The step into the first sample is outside.
        tallies.append(so_far[here + 1] - so_far[first + 1])
    found = Sets(leave, first, np.empty(0), np.empty(0), *tallies)
    for begin, end in samples.unordered():
        _one_by_one(samples, window, begin, end, found)
    gone = np.cumsum(np.bincount(leave, minlength=count + 1))[:count]
    found.left, found.count = gone, here + 1 - gone
    return found


def _one_by_one(samples: Samples, window: int, begin: int, end: int, found: Sets) -> None:
    """The sets of one sensor, kept as a sorted list of places in time."""
    sorted_at = samples.at[samples.order]
    cuts = np.searchsorted(sorted_at, samples.at[begin:end] - window, side="left")
    places = samples.place[begin:end]
    low = int(places.min())
    # Plain arrays, as a number of Python's takes four times the room of an array's.
    in_time = samples.order[low : low + end - begin]
    values, known = array("d", samples.values[in_time].tobytes()), samples.valued[in_time].tobytes()
    arrived = samples.order
    held: list[int] = []
    head = rises = falls = steps = 0
    found.leave[begin:end] = end

    def step(a: int, b: int) -> tuple[int, int, int]:
        x, y = values[a - low], values[b - low]
        return (y > x, y < x, 1) if known[a - low] and known[b - low] else (0, 0, 0)

    def pairs() -> Iterator[tuple[int, int]]:
        for start in range(0, len(cuts), ASKED_AT_ONCE):
            part = slice(start, start + ASKED_AT_ONCE)
            yield from zip(cuts[part].tolist(), places[part].tolist(), strict=True)

    for number, (cut, place) in enumerate(pairs(), start=begin):
        kept = bisect_left(held, cut, head)
        for k in range(head, kept):
            found.leave[arrived[held[k]]] = number
            if k + 1 < len(held):
                up, down, one = step(held[k], held[k + 1])
                rises, falls, steps = rises - up, falls - down, steps - one
        head = kept
        spot = bisect_left(held, place, head)
        before = held[spot - 1] if spot > head else None
        after = held[spot] if spot < len(held) else None
        for a, b, sign in ((before, place, 1), (place, after, 1), (before, after, -1)):
            if a is not None and b is not None:
                up, down, one = step(a, b)
                rises, falls, steps = rises + sign * up, falls + sign * down, steps + sign * one
        held.insert(spot, place)
        if head > 64 and 2 * head > len(held):
            del held[:head]
            head = 0
        found.first[number] = arrived[held[head]]
        found.rises[number], found.falls[number], found.steps[number] = rises, falls, steps


class Smaller:
    """How many of the first ``p`` ranks are smaller than ``x``, for arrays of both (a wavelet matrix)."""

    def __init__(self, ranks: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (ranks >> bit) & 1 == 1
            zeros = np.zeros(len(ranks) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            ranks = np.concatenate([ranks[~ones], ranks[ones]])

    def count(self, prefix: np.ndarray, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(prefix), np.int64)
        for start in range(0, len(prefix), ASKED_AT_ONCE):
            asked = slice(start, start + ASKED_AT_ONCE)
            total[asked] = self._count(prefix[asked], x[asked])
        return total

    def _count(self, prefix: np.ndarray, x: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(prefix), np.int64), prefix.astype(np.int64)
        total = np.zeros(len(prefix), np.int64)
        for bit, zeros in self.levels:
            below, upto = zeros[low], zeros[high]
            one = (x >> bit) & 1 == 1
            total += np.where(one, upto - below, 0)
            low = np.where(one, zeros[-1] + low - below, below)
            high = np.where(one, zeros[-1] + high - upto, upto)
        return total


class Beyond:
    """Tests of values against a limit of each sample's own, over its set: ``value > limit``.

    ``sign`` -1 turns the test round. No value and not-a-number pass no test, and pass no limit either.
    """

    def __init__(self, samples: Samples, sets: Sets, sign: int = 1):
        self.samples, self.sets = samples, sets
        self.values = samples.values * sign
        self.sign = sign
        self.leaving = np.argsort(sets.leave, kind="stable")
        self._ranked = None

    def _ranks(self):
        if self._ranked is None:
            known = np.unique(self.values[~np.isnan(self.values)])
            # Rank 0 has no value and passes no limit.
            ranks = np.where(np.isnan(self.values), 0, np.searchsorted(known, self.values) + 1).astype(np.int32)
            bits = int(len(known) + 1).bit_length()
            self._ranked = known, ranks, Smaller(ranks, bits), Smaller(ranks[self.leaving], bits)
        return self._ranked

    def _few(self, limits: np.ndarray) -> np.ndarray | None:
        different = np.unique(limits[~np.isnan(limits)])
        return different if len(different) <= FEW else None

    def counts(self, limits: np.ndarray) -> np.ndarray:
        limits = limits * self.sign
        here, left = np.arange(len(limits)), self.sets.left
        out = np.zeros(len(limits), np.int64)
        few = self._few(limits)
        if few is not None:
            for limit in few.tolist():
                test = self.values > limit
                entered = np.cumsum(test)
                gone = np.concatenate([[0], np.cumsum(test[self.leaving])])
                rows = np.flatnonzero(limits == limit)
                out[rows] = entered[rows] - gone[left[rows]]
            return out
        known, _, entered, gone = self._ranks()
        rows = here[~np.isnan(limits)]
        x = np.searchsorted(known, limits[rows], side="right") + 1
        inside = (rows + 1 - left[rows]) - (entered.count(rows + 1, x) - gone.count(left[rows], x))
        out[rows] = inside
        return out

    def latest(self, limits: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The place in time of the latest value beyond the limit in the sets of ``rows``, which hold one; else -1.

        The latest one so far is looked up first. It has left only where the set's values beyond the limit all came
        more than a window late; these sets are searched through.
        """
        limits = limits[rows] * self.sign
        best = np.full(len(rows), -1, np.int64)
        few = self._few(limits)
        if few is not None:
            for limit in few.tolist():
                mine = limits == limit
                so_far = np.maximum.accumulate(np.where(self.values > limit, self.samples.place, -1))
                best[mine] = so_far[rows[mine]]
        else:
            known, ranks, *_ = self._ranks()
            real = ~np.isnan(limits)
            x = np.searchsorted(known, limits[real], side="right") + 1
            best[real] = _latest_of_prefix(ranks, self.samples.place, rows[real] + 1, x)
        gone = (best >= 0) & (self.sets.leave[self.samples.order[best]] <= rows)
        if gone.any():
            # The earliest arrival still in each set.
            oldest = np.searchsorted(np.maximum.accumulate(self.sets.leave), rows, side="right")
            for k in np.flatnonzero(gone).tolist():
                span = slice(int(oldest[k]), int(rows[k]) + 1)
                fits = (self.values[span] > limits[k]) & (self.sets.leave[span] > rows[k])
                best[k] = self.samples.place[span][fits].max() if fits.any() else -1
        return best


def _latest_of_prefix(ranks: np.ndarray, place: np.ndarray, prefix: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The largest place among the first ``prefix`` samples whose rank is ``x`` or more, else -1.

    A prefix is cut into blocks of powers of two, each kept sorted by rank with the largest place from there on.
    """
    count = len(ranks)
    wide = int(ranks.max(initial=0)) + 2
    best = np.full(len(prefix), -1, np.int64)
    for level in range(count.bit_length()):
        asked = np.flatnonzero((prefix >> level) & 1)
        if not len(asked):
            continue
        block = np.arange(count) >> level
        keys = block * wide + ranks
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        # Blocks run backwards here, so that what follows a block cannot pass for a part of it.
        shift = (block[-1] - block) * (count + 1)
        onwards = np.maximum.accumulate((place[order] + shift)[::-1])[::-1] - shift
        number = (prefix[asked] >> (level + 1)) << 1
        spot = np.searchsorted(keys, number * wide + np.minimum(x[asked], wide - 1), side="left")
        inside = spot < np.minimum((number + 1) << level, count)
        rows = asked[inside]
        best[rows] = np.maximum(best[rows], onwards[spot[inside]])
    return best


def limit_figures(
    samples: Samples, sets: Sets, low: np.ndarray, high: np.ndarray, sigma_of_range: float
) -> dict[str, np.ndarray]:
    """Counts beyond each reading's own limits and bands, and the latest value outside the limits (NaN: none)."""
    mean, sigma = (low + high) / 2.0, (high - low) * sigma_of_range

    def beyond(sign: int, limit: np.ndarray) -> tuple[np.ndarray, ...]:
        """Counts beyond the limit and the two bands of a side, and the place of the latest value beyond the limit."""
        side = Beyond(samples, sets, sign)
        counts = side.counts(limit)
        place = np.full(len(limit), -1, np.int64)
        rows = np.flatnonzero(counts)
        place[rows] = side.latest(limit, rows)
        return counts, side.counts(mean + sign * (sigma * 2)), side.counts(mean + sign * sigma), place

    leaving = np.argsort(sets.leave, kind="stable")
    number = np.cumsum(~np.isnan(samples.values))
    number_gone = np.concatenate([[0], np.cumsum(~np.isnan(samples.values[leaving]))])
    numbers = number - number_gone[sets.left]
    valued = np.cumsum(samples.valued)
    gone = np.concatenate([[0], np.cumsum(samples.valued[leaving])])
    out = {"valued": valued - gone[sets.left]}
    # One side after the other, as the ranks of a side take the most room.
    above, out["far_above"], out["some_above"], latest_above = beyond(1, high)
    below, out["far_below"], out["some_below"], latest_below = beyond(-1, low)
    # Between crossed limits every number is outside.
    out["breaches"] = np.where(low > high, numbers, above + below)
    rows = np.flatnonzero(out["breaches"])
    latest = np.full(len(low), np.nan)
    latest[rows] = samples.values[samples.order[np.maximum(latest_above, latest_below)[rows]]]
    out["latest_breach"] = latest
    return out


# Workers get these functions with the task; nothing has to be installed there.
register_pickle_by_value(sys.modules[__name__])
