"""Benchmark decontamination by size-partitioned MinHash containment search (operator 3).

Test items are short, documents are long, so the similarity of an item and a document says nothing. Items are put into
classes by their number of shingles, doubling from class to class, and each class looks at documents through windows of
twice its largest item, half overlapping: an item that a document holds lies in one window whole, and the similarity of
item and window has a known lower limit. From it follows how many MinHash functions meet at least once with
probability ``TARGET``. Candidates are verified by exact containment of the item's shingles of words in the document.

A window can share a minimum with an item only if it holds a shingle that is a minimum of an item. These shingles are
looked up first, and the minima are computed for windows that hold one.

The items' index, their texts and sorted arrays of minima, is broadcast in blocks of at most ``BLOCK_BYTES``, as it is
built; a larger benchmark takes several passes. A candidate's shingles are cut from its text when it is verified.

Defined results: null and empty texts, documents and items of fewer than ``SHINGLE`` words have no shingles and match
nothing; repeated rows match one by one, equal ids give equal rows once each; empty tables give an empty result; extra
columns are ignored, null ids are passed on.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilnwatch.llm.hashing import PLAIN, STEP, Words, mix
from kilnwatch.llm.tables import filter_texts, map_texts

SHINGLE = 5
CONTAINMENT = 0.8
TARGET = 0.99999
BLOCK_BYTES = 32 << 20
#: Candidates whose shingles a task keeps at hand.
KEPT_ITEMS = 1024
SCHEMA = "doc_id bigint, item_id bigint, n_shingles bigint, n_found bigint, containment double"
#: Punctuation beyond ASCII that separates words as well.
PUNCTUATION = re.compile("[\u00a1\u00ab\u00bb\u00bf\u2000-\u206f\u3000-\u303f]+")


def plain(text: str) -> bytes:
    """Lower case, with separators beyond ASCII as spaces."""
    return PUNCTUATION.sub(" ", text.lower()).encode()


def functions_needed(containment: float = CONTAINMENT, target: float = TARGET) -> int:
    """MinHash functions of which one meets with probability ``target`` at the least similarity of a window.

    A class holds items of q to 2q shingles, its windows 4q: containment c leaves c q of 4q + (1 - c) q.
    """
    least = containment / (4 + 1 - containment)
    return math.ceil(math.log(1 - target) / math.log(1 - least))


def _seeds(functions: int) -> np.ndarray:
    return mix(np.arange(1, functions + 1, dtype=np.uint64) * STEP)


def minima(shingles: np.ndarray, functions: int) -> np.ndarray:
    """The smallest value of each function over the shingles."""
    return np.array([mix(shingles ^ seed).min() for seed in _seeds(functions)], np.uint64)


def _keys(values: np.ndarray, function: int | np.ndarray) -> np.ndarray:
    """Minima of several functions as keys of one table; what shares a key by chance is verified like any other."""
    return mix(values + np.asarray(function, np.uint64) * STEP)


def index_bytes(items: int, texts: int) -> int:
    """The size of an index: of each function a key, an item's number and a shingle."""
    return texts + items * (functions_needed() * 20 + 16)


class ItemIndex:
    """A block of items: texts, and by class the sorted keys of their minima with the items' numbers."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.functions = functions_needed()
        texts = [plain(text or "") for _, text in items]
        words = Words(texts, PLAIN)
        hashes, inside = words.sequences(SHINGLE)
        places = np.flatnonzero(inside)
        owner = np.searchsorted(words.bounds, places, side="right") - 1
        held, sizes = np.unique(owner, return_counts=True)
        self.ids = [items[k][0] for k in held.tolist()]
        self.texts = [texts[k] for k in held.tolist()]
        self.by_class: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.seeds = np.empty(0, np.uint64)
        if not len(held):
            return
        own = hashes[places]
        starts = np.cumsum(sizes) - sizes
        order = np.lexsort((own, owner))
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[order][1:] != own[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        # The class goes by the number of different shingles.
        different = np.add.reduceat(fresh.astype(np.int64), starts)
        classes = np.frexp(different.astype(np.float64))[1] - 1
        keys = np.empty((self.functions, len(held)), np.uint64)
        seeds = []
        for function, seed in enumerate(_seeds(self.functions)):
            values = mix(own ^ seed)
            least = np.minimum.reduceat(values, starts)
            keys[function] = _keys(least, function)
            seeds.append(np.unique(own[values == np.repeat(least, sizes)]))
        self.seeds = np.unique(np.concatenate(seeds))
        for size in np.unique(classes).tolist():
            rows = np.flatnonzero(classes == size)
            flat = keys[:, rows].ravel()
            place = np.argsort(flat, kind="stable")
            self.by_class[size] = flat[place], np.tile(rows.astype(np.int32), self.functions)[place]
        self._wanted: dict[int, dict[int, set[bytes]]] = {}

    def candidates(self, shingles: np.ndarray, places: np.ndarray) -> set[int]:
        """Items that share a minimum with a window of a document, given where its seeds stand."""
        found: set[int] = set()
        functions = np.arange(self.functions)
        for size, (keys, items) in self.by_class.items():
            span = 4 << size
            half = span // 2
            starts = np.unique(np.concatenate([places // half, np.maximum(places // half - 1, 0)])) * half
            for start in starts.tolist():
                window = np.unique(shingles[start : start + span])
                asked = _keys(minima(window, self.functions), functions)
                first, last = (np.searchsorted(keys, asked, side) for side in ("left", "right"))
                for k in np.flatnonzero(first < last).tolist():
                    found.update(items[first[k] : last[k]].tolist())
        return found

    def shingles(self, item: int) -> dict[int, set[bytes]]:
        """The shingles of an item by their hashes."""
        known = self._wanted.get(item)
        if known is None:
            words = Words([self.texts[item]], PLAIN)
            known = defaultdict(set)
            for place, value in enumerate(words.sequences(SHINGLE)[0].tolist()):
                known[value].add(shingle_words(words, place))
            if len(self._wanted) >= KEPT_ITEMS:
                self._wanted.clear()
            self._wanted[item] = known = dict(known)
        return known


def shingle_words(words: Words, place: int) -> bytes:
    return b" ".join(words.word(place + step) for step in range(SHINGLE))


def found_in(known: ItemIndex, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
    """Text, item, the item's number of shingles and how many of them the text has, for all that reach ``CONTAINMENT``."""
    if not len(known.seeds):
        return []
    words = Words([plain(text.decode()) for text in texts], PLAIN)
    shingles, inside = words.sequences(SHINGLE)
    at = np.minimum(np.searchsorted(known.seeds, shingles), len(known.seeds) - 1)
    seeds = np.flatnonzero((known.seeds[at] == shingles) & inside)
    owner = np.searchsorted(words.bounds, seeds, side="right") - 1
    out = []
    for doc in np.unique(owner).tolist():
        first, last = words.bounds[doc], words.bounds[doc + 1] - SHINGLE + 1
        own = shingles[first:last]
        for item in sorted(known.candidates(own, seeds[owner == doc] - first)):
            wanted = known.shingles(item)
            hashes = np.fromiter(wanted, np.uint64, len(wanted))
            hits = first + np.flatnonzero(np.isin(own, hashes))
            got = {shingle_words(words, place) for place in hits.tolist()}
            size = sum(map(len, wanted.values()))
            count = len(got & set().union(*wanted.values()))
            if count >= CONTAINMENT * size:
                out.append((doc, item, size, count))
    return out


def indexes(items: DataFrame) -> Iterator[Broadcast]:
    """Broadcast indexes of all items, one for each block of bounded size."""
    items = items.select("item_id", "text").distinct()
    context = items.sparkSession.sparkContext
    count, size = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil(index_bytes(count, size or 0) / BLOCK_BYTES))
    for number in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        yield context.broadcast(ItemIndex([tuple(row) for row in block.collect()]))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of document and item with at least ``CONTAINMENT`` of the item's shingles in the document."""
    docs = docs.select("doc_id", "text")
    return reduce(DataFrame.union, [_pairs(docs, index) for index in indexes(items)])


def _pairs(docs: DataFrame, index: Broadcast) -> DataFrame:
    def work(batch, texts):
        known, ids = index.value, batch.column(0).to_pylist()
        found = found_in(known, texts)
        return {
            "doc_id": [ids[doc] for doc, _, _, _ in found],
            "item_id": [known.ids[item] for _, item, _, _ in found],
            "n_shingles": [size for _, _, size, _ in found],
            "n_found": [count for _, _, _, count in found],
            "containment": [count / size for _, _, size, count in found],
        }

    return map_texts(docs, "text", SCHEMA, work)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, with all their columns; no shuffle."""
    for index in indexes(items):
        docs = _without(docs, index)
    return docs


def _without(docs: DataFrame, index: Broadcast) -> DataFrame:
    def keep(texts):
        leaking = {found[0] for found in found_in(index.value, texts)}
        return [doc not in leaking for doc in range(len(texts))]

    return filter_texts(docs, "text", keep)


def leaks_sql() -> str:
    """The same by comparing all shingles, for DuckDB."""
    word = r"[^\x00-/:-\^`\{-\x7f\x{a1}\x{ab}\x{bb}\x{bf}\x{2000}-\x{206f}\x{3000}-\x{303f}]+"

    def shingles(key: str, rows: str) -> str:
        words = f"regexp_extract_all(lower(text), '{word}')"
        return f"""
    SELECT DISTINCT {key}, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS shingle
    FROM (SELECT {key}, {words} AS w FROM {rows}), unnest(range(1, len(w) - {SHINGLE - 2})) AS r(i)"""

    return f"""
WITH items AS ({shingles("item_id", "benchmark")}),
docs AS ({shingles("doc_id", "documents")}),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_found, count(*) / n AS containment
FROM items JOIN docs USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= {CONTAINMENT} * n"""
