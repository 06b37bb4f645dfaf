"""Registered queries of the corpus operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelyard.llm import bpe, decontaminate, filteraudit, fuzzydedup, licensescan, linededup, neardup, pii, pitmanyor, quality, suffixdedup, toxicity, whitening
from reelyard.llm.common import table


def op1_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_chained_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzydedup.report(table(spark, sf_dir, "documents"))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op4_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score(table(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.report(table(spark, sf_dir, "documents"))


def op6_bloom_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # A key for runs on test data; a real run brings its own secret.
    return pii.replace(docs, b"key of the test data", counted=True).select("doc_id", "n_entities", "text")


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.report(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_superminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licensescan.report(table(spark, sf_dir, "documents"))


def op12_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_kneser_ney_toxicity": op1_kneser_ney_toxicity,
    "op2_chained_substrings": op2_chained_substrings,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_pitman_yor_scores": op4_pitman_yor_scores,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_bloom_line_dedup": op6_bloom_line_dedup,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_string_tiling": op9_string_tiling,
    "op10_superminhash_neardup": op10_superminhash_neardup,
    "op7_quality_rules": op7_quality_rules,
    "op11_license_templates": op11_license_templates,
    "op12_lanczos_whitening": op12_lanczos_whitening,
    "op13_filter_audit": op13_filter_audit,
}
