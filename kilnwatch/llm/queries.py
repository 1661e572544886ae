"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kilnwatch.llm.chat import chat_digests, chat_sql, with_probe
from kilnwatch.llm.collocations import collocations, collocations_sql
from kilnwatch.llm.decontaminate import leaks, leaks_sql
from kilnwatch.llm.divergence import divergence, divergence_sql
from kilnwatch.llm.html import main_texts
from kilnwatch.llm.jaccard import jaccard_classes
from kilnwatch.llm.license import license_sql, licenses
from kilnwatch.llm.quality import quality
from kilnwatch.llm.secret_scan import secrets
from kilnwatch.llm.substring_dedup import repeats_removed as repeated_words_removed
from kilnwatch.llm.suffixes import repeats_removed as repeated_bytes_removed
from kilnwatch.llm.tables import table
from kilnwatch.llm.tokens import token_digests
from kilnwatch.llm.warc import archived

RANKS = "byte_bpe_50k.tiktoken"


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes_removed(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words_removed(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digests(with_probe(table(spark, sf_dir, "conversations")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": op1_license_scans,
    "op2_html_extraction": op2_html_extraction,
    "op3_decontamination": op3_decontamination,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secret_scans": op7_secret_scans,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_warc": op9_warc,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_collocations": op13_collocations,
}

#: The others cannot be written in SQL; their tests compare with brute force.
LLM_ORACLES: dict[str, str] = {
    "op1_license_scans": license_sql(),
    "op3_decontamination": leaks_sql(),
    "op11_source_divergence": divergence_sql(),
    "op12_chat_formatting": chat_sql(),
    "op13_collocations": collocations_sql(),
}
