"""Substring dedup by suffix automata (operator 10).

A word is removed where it lies in a window of 13 words that also starts in a document with a smaller id. The texts
around repeated anchors are the reference. It is cut into shards by anchor, each small enough for one suffix automaton;
the automaton's states know the least id of the documents that hold their strings. Each document's contexts run through
the automaton of their shard; where the matching statistics reach the window's length, the state tells the least id.

The reference is the whole corpus, which has no bound, so its automata are not sent to all tasks. A window can only
match in the shard of its anchor, and contexts go there instead.

Defined results: null texts have no words; documents with a null id neither lose words nor count as smaller; repeated
rows of one id do not count as smaller than each other; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kilnwatch.llm.hashing import WHITE, Words
from kilnwatch.llm.repeats import Unit, dealt, judged, unpacked
from kilnwatch.llm.tables import _arrow_schema

LENGTH = 13
GRAM = 5
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def word_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, WHITE)
    return words.sequences(GRAM)[0], words.bounds[1:]


WORDS = Unit(LENGTH, LENGTH - GRAM + 1, word_grams, True, bytes.split, b" ".join)


class Automaton:
    """Suffix automaton of several word sequences; each state keeps the least id of what it stands for."""

    def __init__(self):
        self.moves: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.least = [1 << 63]

    def _copy(self, state: int, word, source: int, size: int) -> int:
        """A state for the shorter strings of ``source``, put in its place from ``state`` upwards."""
        clone = len(self.moves)
        self.moves.append(self.moves[source].copy())
        self.link.append(self.link[source])
        self.size.append(size)
        self.least.append(self.least[source])
        self.link[source] = clone
        while state >= 0 and self.moves[state].get(word) == source:
            self.moves[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list, key: int) -> None:
        moves, link, size = self.moves, self.link, self.size
        last = 0
        for word in words:
            target = moves[last].get(word)
            if target is not None:
                last = target if size[target] == size[last] + 1 else self._copy(last, word, target, size[last] + 1)
            else:
                state = len(moves)
                moves.append({})
                link.append(0)
                size.append(size[last] + 1)
                self.least.append(1 << 63)
                at = last
                while at >= 0 and word not in moves[at]:
                    moves[at][word] = state
                    at = link[at]
                if at >= 0:
                    target = moves[at][word]
                    link[state] = target if size[target] == size[at] + 1 else self._copy(at, word, target, size[at] + 1)
                last = state
            if key < self.least[last]:
                self.least[last] = key

    def finish(self) -> None:
        """Hand the least ids on to the states of shorter strings."""
        least, link = self.least, self.link
        for state in sorted(range(1, len(link)), key=self.size.__getitem__, reverse=True):
            if least[state] < least[link[state]]:
                least[link[state]] = least[state]

    def least_ids(self, words: list, length: int = LENGTH) -> list[int | None]:
        """For each window of ``length`` words the least id that holds it."""
        moves, link, size = self.moves, self.link, self.size
        state = matched = 0
        out = []
        for place, word in enumerate(words, 1):
            while state and word not in moves[state]:
                state = link[state]
                matched = size[state]
            target = moves[state].get(word)
            if target is not None:
                state, matched = target, matched + 1
            # Longer matches than the window are cut to it: the state of its last ``length`` words.
            if matched >= length:
                while size[link[state]] >= length:
                    state = link[state]
                matched = length
            if place >= length:
                out.append(self.least[state] if matched >= length else None)
        return out


def judge(contexts: list[bytes], counts: list[int], least: list[int], edges: np.ndarray) -> list:
    out: list = []
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        # Texts without an id are not part of the reference.
        automaton = Automaton()
        split = [context.split() for context in contexts[first:last]]
        for words, key in zip(split, least[first:last], strict=True):
            if key is not None:
                automaton.add(words, key)
        automaton.finish()
        out += map(automaton.least_ids, split)
    return out


def repeats_removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the kept words of each document."""
    table = dealt(docs.select("doc_id", "text"))
    spans = judged(table, WORDS, "array<bigint>", judge, "array_min(verdict) < key")
    schema = _arrow_schema(docs.sparkSession, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, numbers, texts in unpacked(batches, ["copies", "spans"]):
            out = []
            for (key, copies, own), number, text in zip(rows, numbers, texts, strict=True):
                words = text.split()
                steps = np.zeros(len(words) + 1, np.int64)
                for span in own or ():
                    if span["part"] == number and key is not None:
                        for step, least in enumerate(span["verdict"]):
                            if least is not None and least < key:
                                steps[span["first"] + step] += 1
                                steps[span["first"] + step + LENGTH] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                kept = words if not gone.any() else [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
                out += [(key, len(words), len(words) - len(kept), digest)] * copies
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
            )

    return table.join(spans, "row", "left").mapInArrow(run, SCHEMA)
