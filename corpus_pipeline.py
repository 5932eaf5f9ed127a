"""Corpus pipeline over ``documents``: quality, exact and near copies, benchmark leaks, packing.

Each stage works on all rows that the one before kept; its result is written as
Parquet and read again.  All stages but the last return the columns of
``documents``; the last gives the packed pieces.  The stages keep what their
operators state for nulls, empty and repeated rows; columns beyond those named
here pass through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlake.llm import decontaminate, exact_dedup, near_dedup, pack, quality
from feedlake.llm.common import stage, table
from feedlake.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.3 or more)."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the smallest id."""
    return near_dedup.drop_near_copies(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2,048 tokens."""
    return pack.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packing),
]

#: A learned model, MinHash and a tokenizer cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"{k}_{name}")
    return docs
