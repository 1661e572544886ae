"""Suffix sorting by external induction, and exact repeats of a fixed length in documents (operator 8).

Induced sorting orders the suffixes of a shard of texts from the order of few of them, the LMS suffixes (a character
that is smaller than the next, after one that is larger). The LMS substrings are named by sorted tuples of their
characters; the string of names is sorted by the same induction while its alphabet fits the queues, else by doubling.
From the LMS suffixes two passes over the alphabet induce all others: a queue for each character takes tuples of suffix
and common prefix with the tuple before it; a queue is emptied in order and feeds the queues of the characters that
precede its suffixes. Queues beyond ``MEMORY`` bytes are spilled to one scratch file, which the task that sorts deletes.

Common prefixes are carried along, cut at the length of interest: the prefix of two suffixes that were induced one
after the other is one more than the least prefix between the suffixes that induced them.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilnwatch.llm.repeats import Unit, dealt, judged, unpacked
from kilnwatch.llm.tables import _arrow_schema
from kilnwatch.llm.winnow import byte_grams

#: Bytes of queue entries kept in memory, and the largest alphabet that has queues.
MEMORY = 64 << 20
MOST_QUEUES = 1024

#: Suffixes and prefixes are kept narrow: a shard has less than 2**31 characters, a prefix less than 2**15.
PLACE, PREFIX = np.int32, np.int16
#: Where the comparison of two suffixes stops in any case.
FARTHEST = 1 << 14
ENTRY = np.dtype([("suffix", PLACE), ("prefix", PREFIX)])


class Queues:
    """A queue of (suffix, common prefix) for each character, kept on disk where memory is short."""

    def __init__(self, count: int, memory: int = MEMORY):
        self.held: list[list[np.ndarray]] = [[] for _ in range(count)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(count)]
        self.memory, self.size, self.file = memory, 0, None

    def push(self, queue: int, entries: np.ndarray) -> None:
        self.held[queue].append(entries)
        self.size += entries.nbytes
        if self.size > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for queue, parts in enumerate(self.held):
            if parts:
                data = np.concatenate(parts)
                self.spilled[queue].append((self.file.tell(), len(data)))
                self.file.write(data.tobytes())
                self.held[queue] = []
        self.size = 0

    def pop(self, queue: int) -> np.ndarray:
        """All entries of a queue, in the order they came."""
        parts = []
        for place, count in self.spilled[queue]:
            self.file.seek(place)
            parts.append(np.frombuffer(self.file.read(count * ENTRY.itemsize), ENTRY))
        parts += self.held[queue]
        self.size -= sum(p.nbytes for p in self.held[queue])
        self.held[queue], self.spilled[queue] = [], []
        return np.concatenate(parts) if parts else np.empty(0, ENTRY)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last character is the only least one."""
    count = len(text)
    differs = np.flatnonzero(text[1:] != text[:-1])
    rises = text[1:][differs] > text[:-1][differs]
    out = np.empty(count, bool)
    # Equal neighbours take the type of the next change.
    if count > 1:
        out[:-1] = np.repeat(rises, np.diff(differs, prepend=-1))
    out[-1] = True
    return out


class Prefixes:
    """Common prefixes by direct comparison, seven characters at a time where they fit one number."""

    def __init__(self, text: np.ndarray, letters: int, most: int):
        self.text, self.most = text, most
        self.bits = bits = max(1, int(letters).bit_length())
        self.width = min(8, 63 // bits)
        padded = np.concatenate([text, np.zeros(self.width, text.dtype)]).astype(np.int64)
        self.packed = np.zeros(len(text), np.int64)
        for step in range(self.width):
            self.packed <<= bits
            self.packed |= padded[step : step + len(text)]

    def beginnings(self, places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The first characters of substrings as numbers; the largest character follows a short one's end."""
        beyond = np.maximum(self.width - lengths, 0) * self.bits
        return self.packed[places] >> beyond << beyond | (np.int64(1) << beyond) - 1

    def of_neighbours(self, order: np.ndarray) -> np.ndarray:
        """What each suffix of an ordered list has in common with the one before.

        Going through the text, a suffix and its neighbour often lie as far behind the suffix and neighbour
        before: then their common prefix is what is left of that one. Only where it starts is compared.
        """
        out = np.zeros(len(order), PREFIX)
        if len(order) < 2:
            return out
        by_place = np.argsort(order[1:]) + 1
        own, other = order[by_place].astype(np.int64), order[by_place - 1].astype(np.int64)
        head = np.ones(len(own), bool)
        head[1:] = own[1:] - own[:-1] != other[1:] - other[:-1]
        heads = np.flatnonzero(head)
        long = self._compared(own[heads], other[heads], FARTHEST)
        chain = np.cumsum(head) - 1
        left = long[chain] - (own - own[heads][chain])
        again = np.flatnonzero((left < 0) | (long[chain] == FARTHEST))
        left[again] = self._compared(own[again], other[again], self.most)
        out[by_place] = np.minimum(left, self.most)
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Characters that the suffixes a and b have in common, at most ``most``."""
        return self._compared(a.astype(np.int64), b.astype(np.int64), self.most).astype(PREFIX)

    def _compared(self, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live):
            inside = (np.maximum(x, y) < len(self.text)) & (out[live] < most)
            live, x, y = live[inside], x[inside], y[inside]
            same = self.packed[x] == self.packed[y]
            last = ~same
            step = np.arange(self.width)
            ends = len(self.text) - 1
            differ = self.text[np.minimum(x[last, None] + step, ends)] != self.text[np.minimum(y[last, None] + step, ends)]
            out[live[last]] += differ.argmax(axis=1)
            live, x, y = live[same], x[same] + self.width, y[same] + self.width
            out[live] += self.width
        return np.minimum(out, most)


class RangeLeast:
    """Least value of ranges of a small array."""

    def __init__(self, values: np.ndarray):
        count = len(values)
        self.table = np.empty((count.bit_length(), count), values.dtype)
        self.table[0] = values
        for level in range(1, len(self.table)):
            span = 1 << (level - 1)
            reach = count - 2 * span + 1
            np.minimum(
                self.table[level - 1, :reach], self.table[level - 1, span : span + reach], out=self.table[level, :reach]
            )

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Least of ``values[first..last]``, all ranges nonempty."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, first], self.table[level, last - (1 << level.astype(np.int64)) + 1])


class Pass:
    """One pass of induction: sources come in order and feed the queues of the characters before them."""

    def __init__(self, text: np.ndarray, letters: int, most: int, rising: bool, memory: int):
        self.text, self.most, self.rising = text, most, rising
        self.narrow = letters < 1 << 16
        self.queues = Queues(letters, memory)
        # Least prefix since the last entry of each queue; nothing is common with no entry.
        self.since = np.zeros(letters, PREFIX)

    def feed(self, suffixes: np.ndarray, prefixes: np.ndarray, letter: int, own: bool) -> None:
        """``prefixes`` are common with the source before; ``own``: sources may precede into their own queue."""
        if not len(suffixes):
            return
        before = suffixes - 1
        inside = before >= 0
        letters = np.full(len(suffixes), -1, np.int32)
        letters[inside] = self.text[before[inside]]
        if self.rising:
            goes = letters >= letter if own else letters > letter
        else:
            goes = (letters <= letter if own else letters < letter) & inside
        least = RangeLeast(prefixes)
        total = prefixes.min()
        places = np.flatnonzero(goes)
        if len(places):
            targets = letters[places]
            order = np.argsort(targets.astype(np.uint16) if self.narrow else targets, kind="stable")
            places, targets = places[order], targets[order]
            edges = np.concatenate([[0], np.flatnonzero(targets[1:] != targets[:-1]) + 1, [len(targets)]])
            heads = edges[:-1]
            carried = np.empty(len(places), PREFIX)
            rest = np.ones(len(places), bool)
            rest[heads] = False
            follow = np.flatnonzero(rest)
            carried[follow] = least.of(places[follow - 1] + 1, places[follow])
            start = least.of(np.zeros(len(heads), np.int64), places[heads])
            carried[heads] = np.minimum(self.since[targets[heads]], start)
            entries = np.empty(len(places), ENTRY)
            entries["suffix"] = before[places]
            entries["prefix"] = np.minimum(carried + PREFIX(1), self.most)
            np.minimum(self.since, total, out=self.since)
            tails = places[edges[1:] - 1]
            ends = np.full(len(tails), self.most, PREFIX)
            open_end = tails < len(suffixes) - 1
            ends[open_end] = least.of(tails[open_end] + 1, np.full(int(open_end.sum()), len(suffixes) - 1))
            self.since[targets[heads]] = ends
            # The first entry of a queue has only the character itself in common with whatever else starts with it.
            for head, end in zip(heads.tolist(), edges[1:].tolist(), strict=True):
                self.queues.push(int(targets[head]), entries[head:end])
        else:
            np.minimum(self.since, total, out=self.since)


def induce(
    shared_by: Prefixes, letters: int, lms: np.ndarray, memory: int = MEMORY
) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, and what each has in common with the one before, from the LMS suffixes in order."""
    text, most = shared_by.text, shared_by.most
    lms_prefix = shared_by.of_neighbours(lms)
    first = text[lms]
    bounds = np.searchsorted(first, np.arange(letters + 1))
    large: list[tuple[np.ndarray, np.ndarray]] = []
    rising = Pass(text, letters, most, True, memory)
    for letter in range(letters):
        found, prefixes = [], []
        wave = rising.queues.pop(letter)
        while len(wave):
            found.append(wave["suffix"])
            prefixes.append(wave["prefix"].copy())
            if len(found) == 1:
                prefixes[0][0] = 0
            rising.feed(found[-1], prefixes[-1], letter, True)
            wave = rising.queues.pop(letter)
        suffixes = np.concatenate(found) if found else np.empty(0, PLACE)
        shared = np.concatenate(prefixes) if prefixes else np.empty(0, PREFIX)
        large.append((suffixes, shared))
        own = slice(bounds[letter], bounds[letter + 1])
        if own.stop > own.start:
            meeting = lms_prefix[own].copy()
            meeting[0] = shared_by.of(suffixes[-1:], lms[own][:1])[0] if len(suffixes) else 0
            rising.feed(lms[own], meeting, letter, False)
    rising.queues.close()
    falling = Pass(text, letters, most, False, memory)
    order: list[np.ndarray] = []
    common: list[np.ndarray] = []
    for letter in reversed(range(letters)):
        # Right to left: a prefix is common with the suffix to the right.
        found, prefixes = [], []
        wave = falling.queues.pop(letter)
        while len(wave):
            found.append(wave["suffix"])
            prefixes.append(wave["prefix"].copy())
            if len(found) == 1:
                prefixes[0][0] = 0
            falling.feed(found[-1], prefixes[-1], letter, True)
            wave = falling.queues.pop(letter)
        small = np.concatenate(found) if found else np.empty(0, PLACE)
        shared = np.concatenate(prefixes) if prefixes else np.empty(0, PREFIX)
        suffixes, left = large[letter]
        if letter == 0:
            # The end of the text is the least suffix and induces nothing that is smaller.
            small, shared = np.array([len(text) - 1], PLACE), np.zeros(1, PREFIX)
        right = np.empty(0, PREFIX)
        if len(suffixes):
            right = np.empty(len(suffixes), PREFIX)
            right[1:] = left[:0:-1]
            right[0] = shared_by.of(small[-1:], suffixes[-1:])[0] if len(small) else 0
            falling.feed(suffixes[::-1], right, letter, False)
        if letter == 0:
            falling.feed(small, shared, letter, False)
        order += [small, suffixes[::-1]]
        common += [shared, right]
    falling.queues.close()
    suffixes = np.concatenate(order)[::-1]
    right = np.concatenate(common)[::-1]
    # What was common with the right neighbour is common with the left one of that neighbour.
    out = np.zeros(len(suffixes), PREFIX)
    out[1:] = right[:-1]
    return suffixes, out


def names_of(shared_by: Prefixes, lms: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings in text order; smaller names for smaller substrings, equal for equal ones."""
    count = len(lms)
    lengths = np.diff(lms, append=len(shared_by.text) - 1) + 1
    names = np.zeros(count, np.int64)
    active = np.arange(count)
    offset = 0
    while len(active):
        # A substring that is the beginning of another is larger: it ends in a smaller type.
        left = np.maximum(lengths[active] - offset, 0)
        places = np.minimum(lms[active] + offset, len(shared_by.text) - 1)
        key = shared_by.beginnings(places, left)
        order = np.lexsort((key, names[active]))
        key, group = key[order], names[active][order]
        fresh = np.ones(len(active), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        # A name is the number of substrings with smaller names, so that ties leave room for what splits them.
        firsts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        inside = np.arange(len(active)) - np.repeat(firsts, np.diff(np.concatenate([firsts, [len(active)]])))
        place = np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))
        renamed = group + inside[place]
        names[active[order]] = renamed
        offset += shared_by.width
        # Only ties with more characters to come go on.
        sizes = np.bincount(names[active], minlength=1) if len(active) else np.empty(0, int)
        longer = lengths[active] > offset
        undecided = np.zeros(len(sizes), bool)
        undecided[names[active[longer]]] = True
        active = active[(sizes[names[active]] > 1) & undecided[names[active]]]
    return names


def _doubled(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by widening the compared prefixes, three or more ranks in one number each time."""
    ranks = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    count, span = len(text), 1
    while True:
        bits = int(ranks.max()).bit_length()
        width = max(2, 63 // bits)
        key = ranks.copy()
        for step in range(1, width):
            key <<= bits
            if step * span < count:
                key[: count - step * span] |= ranks[step * span :]
        order = np.argsort(key)
        sorted_key = key[order]
        fresh = np.ones(count, np.int64)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        ranks[order] = np.cumsum(fresh)
        span *= width
        if ranks[order[-1]] == count or span >= count:
            return order


def sorted_suffixes(
    text: np.ndarray, letters: int, most: int, memory: int = MEMORY, queues: int = MOST_QUEUES
) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a text in order and what each has in common with the one before, at most ``most``.

    The characters are 0 to ``letters - 1``; the last one is 0 and there is no other 0.
    """
    text = text.astype(np.int32)
    if len(text) == 1:
        return np.zeros(1, PLACE), np.zeros(1, PREFIX)
    small = suffix_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    shared_by = Prefixes(text, letters, most)
    names = names_of(shared_by, lms)
    known, dense = np.unique(names, return_inverse=True)
    if len(known) == len(names):
        order = np.argsort(names)
    elif len(known) <= queues:
        order = sorted_suffixes(dense, len(known), 1, memory, queues)[0]
    else:
        order = _doubled(dense)
    return induce(shared_by, letters, lms[order].astype(PLACE), memory)


LENGTH = 200
GRAM = 32
SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    return byte_grams(np.frombuffer(b"".join(texts), np.uint8), GRAM), ends


BYTES = Unit(LENGTH, LENGTH - GRAM + 1, byte_units, False, bytes, bytes)


def judge(contexts: list[bytes], counts: list[int], least: list[int], edges: np.ndarray) -> list:
    """For each context the runs of windows that occur again: first and last window of each run, in turn."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    # Bytes become 2 to 257; 1 ends a context, 0 the shard.
    shard = np.zeros(int(sizes.sum()) + len(sizes) + 1, np.int32)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    inside = np.ones(len(shard), bool)
    inside[begins[1:] - 1] = inside[-1] = False
    shard[inside] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int32) + 2
    shard[begins[1:] - 1] = 1
    order, shared = sorted_suffixes(shard, 258, LENGTH)
    owner = np.append(np.repeat(np.arange(len(contexts)), sizes + 1), 0)[order]
    whole = (order - begins[owner] <= sizes[owner] - LENGTH) & (order < len(shard) - 1)
    # A suffix without a whole window ends before the length, so it shares less with either neighbour.
    group = np.cumsum((shared < LENGTH) | ~whole)
    times = np.bincount(group[whole], np.array(counts)[owner[whole]], group[-1] + 1)
    again = np.zeros(len(shard) + 1, bool)
    again[order[whole]] = times[group[whole]] > 1
    change = np.flatnonzero(again[1:] != again[:-1]) + 1
    if again[0]:
        change = np.concatenate([[0], change])
    firsts, lasts = change[0::2], change[1::2] - 1
    # A run ends with its context, as the last windows of a context are followed by suffixes without one.
    doc = np.searchsorted(begins, firsts, side="right") - 1
    out: list = [None] * len(contexts)
    runs = np.stack([doc, firsts - begins[doc], lasts - begins[doc]], axis=1)
    for number, first, last in runs.tolist():
        out[number] = [*(out[number] or ()), first, last]
    return out


def repeats_removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the kept bytes of each document.

    A byte is removed where it lies in a string of 200 bytes that also starts anywhere else. The contexts of repeated
    anchors are the shards that are sorted; a group of more than ``HOT`` contexts is dealt out by single windows.

    Defined results: null texts are empty; rows with a null id are compared like others; repeated rows repeat each
    other; an empty table gives an empty result; extra columns are ignored.
    """
    table = dealt(docs.select("doc_id", "text"))
    spans = judged(table, BYTES, "array<int>", judge)
    schema = _arrow_schema(docs.sparkSession, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, numbers, texts in unpacked(batches, ["copies", "spans"]):
            out = []
            for (key, copies, own), number, text in zip(rows, numbers, texts, strict=True):
                gone = []
                for span in own or ():
                    if span["part"] == number:
                        runs = span["verdict"]
                        gone += [
                            (span["first"] + a, span["first"] + b + LENGTH)
                            for a, b in zip(runs[0::2], runs[1::2], strict=True)
                        ]
                merged: list[list[int]] = []
                for first, end in sorted(gone):
                    if merged and first <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([first, end])
                digest, at = hashlib.sha256(), 0
                for first, end in merged:
                    digest.update(text[at:first])
                    at = end
                digest.update(text[at:])
                removed = sum(end - first for first, end in merged)
                row = (key, len(text), removed, len(merged), digest.hexdigest())
                out += [row] * copies
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
            )

    return table.join(spans, "row", "left").mapInArrow(run, SCHEMA)
