"""The audit of sources against plain counting, term by term; odd rows, ties beyond the ranks, empty tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from kilnwatch.llm import divergence as module
from kilnwatch.llm.divergence import divergence, divergence_sql
from kilnwatch.llm.hashing import Words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least_docs=10, ranks=10):
    docs = [(lang or "", source or "", WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in df.items() if n >= least_docs)
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, terms in mine:
            counts[s].update(t for t in terms if df[t] >= least_docs)
        whole = sum(counts.values(), Counter())

        def share(c, t, kept=kept):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in counts.items():
            pairs = [(o, sum(gap(share(c, t), share(d, t)) for t in kept)) for o, d in counts.items() if o != s]
            terms = [(t, gap(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n) for n, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(seed=3):
    rng = random.Random(seed)
    vocabulary = {lang: [f"{lang}w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Ünique", "中文", "É"]
                  for lang in "abc"}
    rows = []
    for i in range(400):
        lang = rng.choice("aaab")
        source = f"s{rng.choice([0, 0, 0, 1, 2, 3])}"
        words = vocabulary[lang]
        skew = words[int(source[1]) * 11 :] if rng.random() < 0.4 else words
        text = "".join(rng.choice([w, w.upper(), w.title()]) + rng.choice(" 1_\n.") for w in rng.choices(skew, k=rng.randint(0, 40)))
        rows.append((i, text, lang, source, len(text)))
    # Ties: many terms of equal counts, in a group of their own.
    rows += [(1000 + i, "tie" + " tie".join("abcdefghijklmnop"), "a", "ties", 9) for i in range(12)]
    rows += [(2000, None, "a", "nothing", 0), (2001, "", None, None, 0), (2002, "word", None, "x", 0), (2002, "word", None, "x", 0)]
    rows += [(None, None, None, None, None), (2003, "12 !!", "d", "only", 0), (2004, "x", "a", None, 0)]
    rows += [(3000, "awaa " * 30000, "b", "long", 0), (3001, "z" * 100_000, "b", "long", 0)]
    return rows


def found(made):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in made.collect())


@pytest.mark.parametrize("least_docs", [10, 1, 1000])
def test_against_plain_counting(spark, documents, least_docs):
    rows = rows_of()
    made = divergence(spark.createDataFrame(rows, DOCS).repartition(5), least_docs)
    assert found(made) == plain(rows, least_docs)


def test_counts_are_passed_on_in_parts(spark, documents, monkeypatch):
    batches = spark.createDataFrame(rows_of(), DOCS).na.fill("").toArrow().to_batches(max_chunksize=50)

    def total(parts):
        sums = Counter()
        for part in parts:
            for row in part.to_pylist():
                sums[row["lang"], row["source"], row["term"], "n"] += row["n"]
                sums[row["lang"], row["source"], row["term"], "docs"] += row["docs"]
        return sums

    whole = list(module._counted(iter(batches)))
    monkeypatch.setattr(module, "HELD", 300)
    parts = list(module._counted(iter(batches)))
    assert len(whole) == 1 < len(parts) and total(whole) == total(parts)


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_colliding_words_are_told_apart_by_their_bytes(monkeypatch, bits):
    whole = Words._hashed
    mask = np.uint64((1 << bits) - 1)
    monkeypatch.setattr(Words, "_hashed", lambda self, points, number=0: whole(self, points, number) & mask)
    words = Words([(r[1] or "").encode() for r in rows_of()], module.APART)
    numbers, places = words.identities()
    texts = [words.word(k) for k in range(len(numbers))]
    assert len(set(zip(texts, numbers.tolist(), strict=True))) == len(set(texts)) == len(places)
    assert [words.word(int(places[n])) for n in numbers] == texts


def test_clashing_columns_and_no_rows(spark, documents):
    rows = spark.createDataFrame(rows_of(), DOCS)
    extra = rows.selectExpr("*", "1 AS term", "2 AS n", "3 AS m", "4 AS counts", "5 AS kinds", "6 AS value", "7 AS docs")
    assert found(divergence(extra)) == plain(rows_of())
    assert found(divergence(rows.limit(0))) == []


def test_the_sql_agrees(spark, documents, tmp_path):
    rows = spark.createDataFrame(rows_of(9), DOCS)
    rows.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({divergence_sql()})").fetchall()
    assert sorted(want) == found(divergence(rows)) == plain(rows_of(9))
