"""Quality rules by compression bands (operator 5).

Zstandard ratios of the whole text and of its fixed chunks must lie inside a band that depends on the length: text
below it repeats itself or is built from few parts, text above it carries no language. Base rules on words come first.

Defined results: a null text has no words and fails the base rules; a null id is passed on; extra columns are ignored;
repeated rows are judged one by one; an empty table gives an empty result. A text is read whole, whatever its length.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from kilnwatch.llm.tables import SPACES, filter_texts, map_texts

LEVEL = 3
CHUNK = 4096
#: The rest of a text after its last whole chunk is judged from this length on.
LEAST_CHUNK = 1024
#: Share of a text's chunks that may lie outside the band.
STRAY_CHUNKS = 0.2
#: Bytes from which a band holds, smallest and largest ratio. Up to 16 KB the lower limits lie about one point below the
#: smallest ratio of texts labelled good in the test tables. Ratios go on falling with the length, and longer texts are
#: rare there: from 16 KB on the limits lie at least ``MARGIN`` below clean texts of four languages, joined without any
#: shared window of words, at the band's upper end (0.38 at 128 KB, 0.36 at 512 KB to 4 MB, where the compressor looks
#: back no further). A text that repeats its half stays below 0.21 there; uniform passages are found by their chunks.
#: The upper limits leave room for dense notation.
MARGIN = 0.05
BANDS = (
    (0, 0.0, 9.0),
    (128, 0.60, 1.1),
    (256, 0.52, 0.95),
    (512, 0.49, 0.85),
    (1024, 0.455, 0.75),
    (2048, 0.44, 0.70),
    (4096, 0.42, 0.68),
    (8192, 0.405, 0.66),
    (16384, 0.34, 0.65),
    (65536, 0.33, 0.65),
    (262144, 0.31, 0.65),
    (2 << 20, 0.30, 0.65),
)
CHUNK_BAND = (0.43, 0.72)
#: Place of the verdict in what ``judge`` returns.
KEPT = 6
LEAST_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, kept boolean, ratio double, n_chunks bigint, stray_chunks bigint"
)


def band(length: int) -> tuple[float, float]:
    """The limits for a text of so many bytes."""
    return next((low, high) for least, low, high in reversed(BANDS) if length >= least)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows whose sequence occurs more than once; ``window`` is a power of two."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ranks = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    # Names of windows of 2, 4 and 8 words from pairs of names of half the length: equal names, equal words.
    span = 1
    while span < window:
        pairs = ranks[:-span] * (int(ranks.max()) + 1) + ranks[span:]
        order = np.argsort(pairs, kind="stable")
        ordered = pairs[order]
        fresh = np.empty(len(pairs), np.int64)
        fresh[0] = 0
        fresh[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        ranks = np.empty_like(fresh)
        ranks[order] = fresh
        if fresh[-1] + 1 == len(fresh):
            return 0
        span *= 2
    again = np.bincount(ranks)[ranks] > 1
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:count] += again
    steps[window:] -= again
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, int, int]:
    """Ratio of the whole text, number of judged chunks and of those outside their band."""
    size = len(text)
    ratio = len(packer.compress(text)) / size
    if size <= CHUNK:
        return ratio, 0, 0
    chunks = stray = 0
    for start in range(0, size, CHUNK):
        chunk = text[start : start + CHUNK]
        if len(chunk) < LEAST_CHUNK:
            continue
        low, high = CHUNK_BAND if len(chunk) == CHUNK else band(len(chunk))
        chunks += 1
        stray += not low <= len(packer.compress(chunk)) / len(chunk) <= high
    return ratio, chunks, stray


def judge(text: bytes, packer: zstandard.ZstdCompressor) -> tuple:
    words = text.split()
    n_words = len(words)
    spaces = len(text) - len(text.translate(None, SPACES))
    points = len(text) if text.isascii() else len(text.decode())
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    failed = n_words < LEAST_WORDS or 100 * repeats > REPEAT_PERCENT * n_words
    ratio, chunks, stray = compression(text, packer) if text else (0.0, 0, 0)
    low, high = band(len(text))
    kept = not failed and low <= ratio <= high and stray <= STRAY_CHUNKS * chunks
    return (
        n_words,
        points - spaces,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        failed,
        kept,
        ratio,
        chunks,
        stray,
    )


def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)


def quality(docs: DataFrame) -> DataFrame:
    """One row per document with the counts of the base rules and the verdict of the bands."""

    def work(batch, texts):
        packer = _packer()
        names = [part.split()[0] for part in SCHEMA.split(", ")][1:]
        columns = zip(*(judge(text, packer) for text in texts), strict=True)
        return {"doc_id": batch.column(0)} | dict(zip(names, map(list, columns), strict=True))

    return map_texts(docs.select("doc_id", "text"), "text", SCHEMA, work)


def good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""

    def keep(texts: list[bytes]) -> list[bool]:
        packer = _packer()
        return [judge(text, packer)[KEPT] for text in texts]

    return filter_texts(docs, "text", keep)
