"""Both operators on repeated strings against plain counting, and suffix sorting against sorting."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import prose, texts

from kilnwatch.llm import repeats, substring_dedup, suffixes


def plain_bytes(rows, length=200):
    seen = Counter()
    for _, text in rows:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def plain_words(rows, length=13):
    least = {}
    for key, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - length + 1 if key is not None else 0):
            window = tuple(words[i : i + length])
            least[window] = min(key, least.get(window, key))
    out = []
    for key, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - length + 1 if key is not None else 0):
            if least[tuple(words[i : i + length])] < key:
                gone[i : i + length] = [True] * length
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((key, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


CASES = [(suffixes, plain_bytes), (substring_dedup, plain_words)]


@pytest.mark.parametrize(("operator", "plain"), CASES)
def test_against_counting(documents, operator, plain):
    rows = texts()
    found = Counter(map(tuple, operator.repeats_removed(documents(rows)).collect()))
    assert found == plain(rows)


@pytest.mark.parametrize(("operator", "plain"), CASES)
def test_hot_groups_are_dealt_anew(documents, operator, plain, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)
    rows = texts(9)
    found = Counter(map(tuple, operator.repeats_removed(documents(rows)).collect()))
    assert found == plain(rows)


@pytest.mark.parametrize(("operator", "plain"), CASES)
def test_rows_of_one_id_spread(documents, operator, plain):
    rng = random.Random(31)
    shared = prose(rng, 60)
    rows = [(key, f"{prose(rng, 20)}{shared}") for key in [None] * 30 + [7] * 20 + [8]]
    rows += [(None, rows[0][1]), (7, rows[40][1]), (7, rows[40][1]), (9, single := prose(rng, 80)), (9, single)]
    dealt = repeats.dealt(documents(rows).select("doc_id", "text"))
    assert dealt.count() == 52 and dealt.agg({"copies": "sum"}).first()[0] == len(rows)
    assert dealt.where("key IS NULL").select(F.spark_partition_id()).distinct().count() > 1
    # What a row meets in the join are its own anchors, not those of all rows of its id.
    assert dealt.select("row").distinct().count() == 52
    assert Counter(map(tuple, operator.repeats_removed(documents(rows)).collect())) == plain(rows)


@pytest.mark.parametrize(("operator", "plain"), CASES)
def test_empty_table_and_more_columns(documents, operator, plain):
    assert operator.repeats_removed(documents([])).collect() == []
    rows = documents(texts()[:6]).selectExpr("*", "1 AS key", "2 AS h", "'x' AS packed", "3 AS size")
    assert Counter(map(tuple, operator.repeats_removed(rows).collect())) == plain(texts()[:6])


def sorted_plainly(text, most):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0] * len(text)
    for at in range(1, len(text)):
        a, b = order[at - 1], order[at]
        while shared[at] < most and max(a, b) + shared[at] < len(text) and text[a + shared[at]] == text[b + shared[at]]:
            shared[at] += 1
    return order, shared


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.integers(1, 4), max_size=60), st.integers(1, 9), st.sampled_from([1, 3]), st.sampled_from([64, 1 << 20]),
    st.sampled_from([2, 1024]),
)
def test_suffixes_and_common_prefixes(body, most, times, memory, queues):
    text = [*(body * times), 0]
    order, shared = suffixes.sorted_suffixes(np.array(text), 5, most, memory, queues)
    assert (order.tolist(), shared.tolist()) == sorted_plainly(text, most)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=14), min_size=1, max_size=6), st.integers(1, 5))
def test_automaton_knows_least_ids(sequences, length):
    automaton = substring_dedup.Automaton()
    for key, words in enumerate(sequences):
        automaton.add(words, 10 - key)
    automaton.finish()
    for words in [*sequences, [0, 1, 2, 0, 5, 1]]:
        for at, found in enumerate(automaton.least_ids(words, length)):
            window = words[at : at + length]
            holders = [
                10 - key for key, other in enumerate(sequences)
                if any(other[i : i + length] == window for i in range(len(other)))
            ]
            assert found == (min(holders) if holders else None)


@pytest.mark.parametrize(("operator", "plain"), CASES)
def test_no_id_is_like_another(documents, operator, plain):
    """The least and the largest number are ids like others, and none is none, also beside equal texts."""
    rng = random.Random(6)
    passage, whole = prose(rng, 70), prose(rng, 90)
    ids = [None, -(1 << 63), (1 << 63) - 1, 0, -1]
    rows = [(key, prose(rng, 20) + passage) for key in ids] + [(key, whole) for key in [*ids, None, -(1 << 63)]]
    found = Counter(map(tuple, operator.repeats_removed(documents(rows)).collect()))
    assert found == plain(rows)
    assert sum(n for row, n in found.items() if row[0] is None) == 3
