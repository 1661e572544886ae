"""Anchors of long repeated strings: every window of a fixed length has one, chosen by its content alone.

The anchor of a window is its gram of least hash, the leftmost among equals. Equal windows have equal anchors, so a
window that occurs again is found where its anchor's hash occurs again. Runs of windows that share an anchor are taken
together; each window belongs to exactly one run.
"""

from __future__ import annotations

import numpy as np

from kilnwatch.llm.hashing import BASE, _byte_values, mix


def byte_grams(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each position on; the length is a power of two."""
    found = _byte_values()[data]
    span, power = 1, int(BASE)
    while span < length:
        found = found[:-span] * np.uint64(power & (1 << 64) - 1) + found[span:]
        power = power * power & (1 << 64) - 1
        span *= 2
    return mix(found)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    span, now = 1, values
    while 2 * span <= width:
        now = np.minimum(now[:-span], now[span:])
        span *= 2
    count = len(values) - width + 1
    return np.minimum(now[:count], now[width - span : width - span + count])


def anchors(grams: np.ndarray, width: int, owner_ends: np.ndarray, length: int):
    """First and last window, and the anchor's hash, of each run of windows with one anchor.

    ``grams`` are the hashes of all texts in a row, ``width`` the grams of a window of ``length`` units, ``owner_ends``
    the end of each text. Windows that cross an end are left out.
    """
    count = len(grams) - width + 1
    if count <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    least = sliding_least(grams, width)
    # Windows that start in the last length - 1 units of a text cross its end.
    steps = np.zeros(count + 1, np.int32)
    begins = np.concatenate([[0], owner_ends[:-1]])
    np.add.at(steps, np.clip(np.maximum(owner_ends - length + 1, begins), 0, count), 1)
    np.add.at(steps, np.clip(owner_ends, 0, count), -1)
    valid = np.cumsum(steps[:count]) == 0
    new = np.ones(count, bool)
    new[1:] = (least[1:] != least[:-1]) | (grams[: count - 1] == least[:-1]) | (valid[1:] != valid[:-1])
    edges = np.flatnonzero(new)
    last = np.concatenate([edges[1:], [count]]) - 1
    kept = valid[edges]
    return edges[kept], last[kept], least[edges[kept]]
