"""Corpus pipeline: from raw documents to tokens, in stages that each work on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kilnwatch.llm.decontaminate import decontaminated
from kilnwatch.llm.jaccard import one_of_each
from kilnwatch.llm.quality import good
from kilnwatch.llm.queries import RANKS
from kilnwatch.llm.secret_scan import redacted
from kilnwatch.llm.tables import shipped, table, written
from kilnwatch.llm.tokens import encoded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the compression bands reject go."""
    shipped(spark)
    return good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents at a Jaccard similarity of 0.8 or more, the one with the least id stays."""
    shipped(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay, n_chars follows."""
    shipped(spark)
    return redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and byte offsets of each document."""
    shipped(spark)
    return encoded(docs, public_tokenizers.path(RANKS))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("tokens", tokens),
]

#: Compression ratios, the forest and the merges cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
