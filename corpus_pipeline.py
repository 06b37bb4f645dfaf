"""Corpus preparation: quality rules, line dedup, near-duplicate removal, decontamination, BPE token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reelyard.llm import bpe, decontaminate, linededup, neardup, quality
from reelyard.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more of the remaining documents go from all of them; the documents stay."""
    return linededup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the passages of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN)


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the fitted quality verdict, so the run is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs
