"""The pipeline's stages against a plain version, and the registered queries."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import corpus_pipeline
import pytest
import zstandard
from compare import database, differences
from test_matching import plain_classes

from kilnwatch.llm import decontaminate, quality, secret_scan, tokens
from kilnwatch.llm.queries import LLM_ORACLES, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_against_sql(spark, name):
    ours, theirs, extra, missing = differences(LLM_QUERIES[name](spark, SF_DIR), LLM_ORACLES[name], database(SF_DIR))
    assert (extra, missing) == ([], []) and ours == theirs > 0


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    stages = dict(corpus_pipeline.STAGES)

    def run(name, given):
        return stages[name](spark, spark.createDataFrame(given, docs.schema), SF_DIR)

    packer = zstandard.ZstdCompressor(level=3)
    good = [r for r in rows if quality.judge(r[1].encode(), packer)[quality.KEPT]]
    found = run("quality_rules", rows)
    assert found.columns == columns and Counter(map(tuple, found.collect())) == Counter(good)

    least = {key: first for key, first, _ in plain_classes([r[:2] for r in good])}
    single = [r for r in good if least[r[0]] == r[0]]
    found = run("near_duplicates", good)
    assert found.columns == columns and Counter(map(tuple, found.collect())) == Counter(single)
    assert len(single) < len(good) < len(rows)

    strip = str.maketrans({c: " " for c in map(chr, range(128)) if not (c.isalnum() or c == "_")})
    clean = [r for r in single if not leaking_plain(r[1], items, strip)]
    found = run("decontamination", single)
    assert found.columns == columns and Counter(map(tuple, found.collect())) == Counter(clean)

    forest = secret_scan.fit(spark.createDataFrame(clean, docs.schema))
    open_rows = []
    for r in clean:
        text = secret_scan.redact(r[1], forest.findings(r[1], r[3]))
        open_rows.append((r[0], text, r[2], r[3], r[4] if text == r[1] else len(text)))
    found = run("secret_scan", clean)
    assert found.columns == columns and Counter(map(tuple, found.collect())) == Counter(open_rows)

    from kilnwatch.llm.tokens import encode

    found = {r["doc_id"]: r["ids"] for r in run("tokens", open_rows).collect()}
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert found == {r[0]: encode([r[1]], path)[0].tolist() for r in open_rows}
    pieces = tokens._pieces_of(path)
    assert all(b"".join(pieces[i] for i in found[r[0]]).decode() == r[1] for r in open_rows)


def leaking_plain(text, items, strip):
    def words(of):
        return decontaminate.PUNCTUATION.sub(" ", of.lower()).translate(strip).split()

    own = words(text)
    held = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
    for item in items:
        body = words(item["text"])
        wanted = {tuple(body[i : i + 5]) for i in range(len(body) - 4)}
        if wanted and len(held & wanted) >= 0.8 * len(wanted):
            return True
    return False
