"""Collocations against plain counting; colliding hashes, full filters, odd rows, clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from kilnwatch.llm import collocations as module
from kilnwatch.llm.collocations import Slice, collocations, collocations_sql

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def grams(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split("[.,;:!?\x0a-\x0d]", text):
        words = re.findall("[^\x20\x09]+", piece)
        for size in range(1, 6):
            for at in range(len(words) - size + 1):
                yield tuple(words[at : at + size])


def plain(rows, least=100, covered=100, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for gram in grams(text):
            counts.setdefault(lang, Counter())[gram] += 1
            totals[lang] += len(gram) == 1
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if a >= least}
        held = {}
        for g, a in found.items():
            for size in range(2, len(g)):
                for at in range(len(g) - size + 1):
                    sub = g[at : at + size]
                    held[sub] = max(held.get(sub, 0), a)
        best = []
        for g, a in found.items():
            if len(g) < 2 or 100 * held.get(g, 0) >= covered * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            best.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def rows_of(seed=4):
    rng = random.Random(seed)
    words = ["the", "Of", "São", "paulo", "new", "YORK", "中文", " x", "a-b", "it's", "\x00", "É", "end", "of"]
    fixed = ["new york end", "The  são\tpaulo", "a-b it's the end of", "of the of the of the"]
    rows = []
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "?"]) for p in parts)
        rows.append((i, text, rng.choice(["en", "en", "pt", None, ""]), "s", len(text)))
    rows += [(500, None, "en", None, None), (None, "", None, None, None), (501, " ,. ", "xx", "s", 4)]
    rows += [(502, "new york " * 3000, "en", "s", 0), (502, "new york " * 3000, "en", "s", 0), (503, "w" * 70_000, "pt", "s", 0)]
    rows += [(504, "big " * 600_000, "long", "s", 0)]
    return rows


def found(made):
    return sorted(tuple(r) for r in made.collect())


@pytest.mark.parametrize(("least", "covered", "top"), [(100, 100, 2000), (20, 90, 7), (3, 100, 50)])
def test_against_plain_counting(spark, documents, least, covered, top):
    rows = rows_of()
    made = collocations(spark.createDataFrame(rows, DOCS).repartition(4), least, covered, top)
    assert found(made) == plain(rows, least, covered, top)


def test_clashing_columns_and_no_rows(spark, documents):
    rows = spark.createDataFrame(rows_of(), DOCS)
    extra = rows.selectExpr("*", "1 AS phrase", "2 AS n", "3 AS print", "4 AS words", "5 AS k", "6 AS total", "7 AS rank")
    assert found(collocations(extra, 20)) == plain(rows_of(), 20)
    assert found(collocations(rows.limit(0))) == []
    assert found(collocations(rows.where("lang = 'xx'"))) == []


def batches_of(spark, rows):
    made = module._texts(spark.createDataFrame([r for r in rows if r[0] != 504], DOCS))
    return made.toArrow().to_batches(max_chunksize=70)


@pytest.mark.parametrize("bits", [0, 2, 64])
def test_colliding_fingerprints_are_told_apart(spark, documents, monkeypatch, bits):
    """Fingerprints of so few bits collide all the time; the second ones keep phrases apart."""
    whole = Slice.fingerprints
    mask = np.uint64((1 << bits) - 1)
    monkeypatch.setattr(Slice, "fingerprints", lambda s, n, check=False: whole(s, n, check) & (~np.uint64(0) if check else mask))
    rows = rows_of()
    for length in (1, 3):
        grams_of, words_of = module.Counted(), module.Counted()
        for batch in batches_of(spark, rows):
            found, words = module._of_slice(batch, length, None)
            grams_of.add(module._unpacked(module._packed(found)))
            words_of.add(words)
        want = Counter(("und" if r[2] is None else r[2], g) for r in rows if r[0] != 504 for g in grams(r[1]) if len(g) == length)
        assert sorted(grams_of.sum()[2].tolist()) == sorted(want.values())
        if length == 1:
            totals = Counter()
            for (lang, _), count in want.items():
                totals[lang] += count
            assert sorted(n for n in words_of.sum()[2].tolist() if n) == sorted(totals.values())


def test_counts_are_passed_on_in_parts(spark, documents, monkeypatch):
    for held, ranges in ((300, 1), (300, 50), (1 << 20, 8)):
        monkeypatch.setattr(module, "HELD", held)
        monkeypatch.setattr(module, "RANGES", ranges)
        captured = []

        class Frame:
            sparkSession = spark

            def mapInArrow(self, run, schema):
                captured.append(run)
                return self

            def repartition(self, *_):
                return self

            sortWithinPartitions = repartition

        rows = rows_of()
        module._level(Frame(), 2, None, 20)
        packed = [r for b in captured[0](iter(batches_of(spark, rows))) for r in b.to_pylist()]
        packed.sort(key=lambda r: r["bucket"])
        table = pa.RecordBatch.from_pylist(packed, schema=pa.schema([("bucket", pa.int32()), ("entries", pa.binary())]))
        found = [r for b in captured[1](iter([table.slice(0, 7), table.slice(7)])) for r in b.to_pylist()]
        want = Counter(("und" if r[2] is None else r[2], g) for r in rows if r[0] != 504 for g in grams(r[1]) if len(g) == 2)
        assert sorted(r["n"] for r in found) == sorted(n for n in want.values() if n >= 20)
        assert len({r["print"] for r in found}) == len(found) and {r["length"] for r in found} == {2}


def test_a_wrong_pointer_gives_no_phrase(spark, documents):
    docs = module._texts(spark.createDataFrame([(1, "one two three", "en", "s", 1)], DOCS))
    key = docs.first()["key"]
    held = Slice([b"one two three"], ["en"])
    prints = held.fingerprints(2).view(np.int64).tolist()
    checks = (held.fingerprints(2, True) >> np.uint64(32)).tolist()
    pointers = [
        (prints[0], checks[0], 7, key, 0, 2), (prints[1], checks[1], 8, key, 0, 2), (prints[1], checks[0], 9, key, 1, 2),
        (prints[1], checks[1], 5, key, 90, 2), (prints[1], checks[1], 6, key + 1, 1, 2),
    ]
    frequent = spark.createDataFrame(pointers, "print bigint, check bigint, n bigint, key bigint, at bigint, length int")
    keys = spark.sparkContext.broadcast(module.filter_of(frequent.select(frequent.key.alias("print"))))
    assert [tuple(r) for r in module._materialised(docs, frequent, keys).collect()] == [("en", "one two", 7)]


def test_fingerprints_do_not_depend_on_the_place():
    langs = ["a"]
    one = Slice([b"x y z w v"], langs)
    far = Slice([b"q " * 600_000 + b"x y z w v"], langs)
    for length in range(1, 6):
        last = one.fingerprints(length)
        assert np.array_equal(far.fingerprints(length)[-len(last) :], last)
    assert not np.array_equal(Slice([b"x y"], ["b"]).fingerprints(2), one.fingerprints(2)[:1])


def test_the_filter_holds_what_it_was_made_of(spark, documents):
    prints = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, np.int64)
    made = module.filter_of(spark.createDataFrame([(int(p),) for p in prints], "print bigint"))
    assert made.holds(prints.view(np.uint64)).all()
    assert made.holds(np.random.default_rng(2).integers(0, 1 << 63, 5000, np.uint64)).mean() < 0.01


def test_the_sql_agrees(spark, documents, tmp_path):
    rows = spark.createDataFrame([r for r in rows_of(8) if r[0] != 504], DOCS)
    rows.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({collocations_sql(20)})").fetchall()
    assert sorted(want) == found(collocations(rows, 20))
