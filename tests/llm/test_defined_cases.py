"""Nulls, very long texts, empty tables and clashing extra columns, for each operator on documents and each stage."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from samples import prose, texts

from kilnwatch.llm.collocations import collocations
from kilnwatch.llm.decontaminate import leaks
from kilnwatch.llm.divergence import divergence
from kilnwatch.llm.jaccard import jaccard_classes
from kilnwatch.llm.license import licenses
from kilnwatch.llm.quality import quality
from kilnwatch.llm.queries import RANKS
from kilnwatch.llm.secret_scan import secrets
from kilnwatch.llm.tokens import token_digests
from kilnwatch.llm.warc import archived

#: Names that the operators give to columns of their own somewhere.
CLASHES = (
    "row part key size packed copies h c n least first place verdict spans term total counts print at length path run rep"
    " leaf lanes votes k1 k2 text_key class class_id component u v window w value template word said set_k1 set_k2"
    " row_key row_place ids score start item_id shingle digest shard refers_to phrase rank"
).split()


def items(docs):
    spark = docs.sparkSession
    held = " ".join(prose(random.Random(3), 9).split())
    return spark.createDataFrame([(1, held), (None, None), (2, "")], "item_id bigint, text string")


OPERATORS = {
    "licenses": licenses,
    "leaks": lambda docs: leaks(docs, items(docs)),
    "tokens": lambda docs: token_digests(docs, public_tokenizers.path(RANKS)),
    "quality": quality,
    "jaccard": jaccard_classes,
    "secrets": secrets,
    "divergence": divergence,
    "collocations": lambda docs: collocations(docs, 5),
}


def given(documents):
    rng = random.Random(17)
    long = " ".join(prose(rng, 20_000).split()) + ' api_token = "9f8a7c6b5d4e3f2a1b0c9d8e7f6a5b4c" ' + "z" * 300_000
    return documents([*texts(), (70, long), (71, long), (72, "\n" * 200_000)])


def clashing(rows):
    return rows.selectExpr("*", *[f"concat('x', doc_id) AS {name}" for name in CLASHES if name not in rows.columns])


def counted(rows):
    return Counter(repr(sorted(r.asDict(True).items())) for r in rows.collect())


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators(documents, name):
    docs = given(documents)
    plain, extra = OPERATORS[name](docs), OPERATORS[name](clashing(docs))
    assert plain.columns == extra.columns
    assert counted(plain) == counted(extra)
    empty = OPERATORS[name](clashing(docs).limit(0))
    assert empty.columns == plain.columns and empty.collect() == []


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, documents, tmp_path, place):
    _, stage = corpus_pipeline.STAGES[place]
    docs = given(documents)
    items(docs).coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    plain, extra = stage(spark, docs, str(tmp_path)), stage(spark, clashing(docs), str(tmp_path))
    if place < len(corpus_pipeline.STAGES) - 1:
        assert plain.columns == docs.columns and extra.columns == clashing(docs).columns
    assert counted(plain) == counted(extra.select(*plain.columns))
    empty = stage(spark, clashing(docs).limit(0), str(tmp_path))
    assert empty.columns == extra.columns and empty.collect() == []


def test_archives(spark, documents):
    html = "<p>" + prose(random.Random(1), 60_000) + "</p>"
    pages = spark.createDataFrame([(1, "u", html), (2, None, html), (3, "w", None)], "page_id bigint, url string, html string")
    extra = pages.selectExpr("*", *[f"page_id AS {n}" for n in ("digest", "size", "shard", "refers_to", "range", "reached")])
    assert counted(archived(pages)) == counted(archived(extra))
