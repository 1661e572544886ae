"""Vectorised hashes of the words and word sequences of many texts at once.

Where a hash stands for what was hashed, its module says so; elsewhere hashes only find what is then compared.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np

#: Odd multiplier of the positions; one less than it is twice an odd number, which keeps 63 bits of any difference.
BASE = np.uint64(0x9E3779B97F4A7C17)
MIX = np.uint64(0xBF58476D1CE4E5B9)
STEP = np.uint64(0x94D049BB133111EB)


@cache
def _byte_values(number: int = 0) -> np.ndarray:
    return np.random.default_rng(20240601 + number).integers(0, 1 << 64, 256, np.uint64)


#: Bytes hashed at once; it bounds the tables of powers, and stays in the processor's cache.
CHUNK = 1 << 18


@cache
def _position_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    return tuple(
        np.cumprod(np.concatenate([[np.uint64(1)], np.full(CHUNK, b, np.uint64)]), dtype=np.uint64)
        for b in (BASE, inverse)
    )


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(31))) * MIX
    values = (values ^ (values >> np.uint64(29))) * STEP
    return values ^ (values >> np.uint64(32))


class Words:
    """The words of several texts: byte spans in ``data``, hashes, and the range of words of each text."""

    def __init__(self, texts: list[bytes], separators: np.ndarray):
        self.data = b"\n".join(texts) + b"\n"
        points = np.frombuffer(self.data, np.uint8)
        apart = separators[points]
        # A word starts after a separator and ends before one; the texts are joined by one.
        edges = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        if len(points) and not apart[0]:
            edges = np.concatenate([[0], edges])
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.hashes = self._hashed(points)
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.bounds = np.concatenate([[0], np.searchsorted(self.starts, text_ends)])

    def other_hashes(self) -> np.ndarray:
        """Hashes of the words that have nothing to do with ``hashes``."""
        return self._hashed(np.frombuffer(self.data, np.uint8), 1)

    def _hashed(self, points: np.ndarray, number: int = 0) -> np.ndarray:
        forward, back = _position_powers()
        values = _byte_values(number)
        out = np.empty(len(self.starts), np.uint64)
        first = 0
        while first < len(out):
            begin = int(self.starts[first])
            last = int(np.searchsorted(self.ends, begin + CHUNK, side="right"))
            if last == first:
                # A word longer than a chunk.
                word = self.data[begin : self.ends[first]]
                out[first] = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=bytes([number])).digest(), "little")
                first += 1
                continue
            part = points[begin : self.ends[last - 1]]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * forward[: len(part)], out=sums[1:])
            starts, ends = self.starts[first:last] - begin, self.ends[first:last] - begin
            out[first:last] = (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64)
            first = last
        return mix(out)

    def identities(self) -> tuple[np.ndarray, np.ndarray]:
        """A number of each word's text, equal for equal words only, and a word of each number.

        Words of one hash are compared byte by byte.
        """
        _, first, numbers = np.unique(self.hashes, return_index=True, return_inverse=True)
        data = np.frombuffer(self.data, np.uint8)
        own, other = self.starts, self.starts[first][numbers]
        lengths = self.ends - own
        same = lengths == (self.ends[first] - self.starts[first])[numbers]
        order = np.argsort(lengths, kind="stable")
        order = order[same[order]]
        sorted_lengths = lengths[order]
        place, live = 0, 0
        while live < len(order):
            rows = order[live:]
            same[rows] &= data[own[rows] + place] == data[other[rows] + place]
            place += 1
            live = int(np.searchsorted(sorted_lengths, place, side="right"))
        known: dict[bytes, int] = {}
        more = []
        for row in np.flatnonzero(~same).tolist():
            number = known.setdefault(self.word(row), len(known))
            numbers[row] = len(first) + number
            if number == len(more):
                more.append(row)
        return numbers, np.concatenate([first, np.array(more, first.dtype)])

    def word(self, number: int) -> bytes:
        return self.data[self.starts[number] : self.ends[number]]

    def sequences(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the words from each position on, and whether they belong to one text."""
        count = max(0, len(self.hashes) - length + 1)
        found = np.zeros(count, np.uint64)
        for step in range(length):
            found = found * BASE + self.hashes[step : step + count]
        inside = np.ones(len(self.hashes), bool)
        for back in range(1, length):
            crossing = self.bounds[1:] - back
            inside[crossing[crossing >= 0]] = False
        return mix(found), inside[:count]


def separators_of(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: What separates words in the contracts: space and U+0009 to U+000D.
WHITE = separators_of((9, 13), (32, 32))
#: What separates words after lower-casing: all of ASCII but letters, digits and the underscore.
PLAIN = separators_of((0, 47), (58, 94), (96, 96), (123, 127))
