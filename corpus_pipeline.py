"""Corpus pipeline: quality, near-duplicates, benchmark leaks, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner writes it as Parquet
and gives it, read again, to the next stage. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, mixing, quality, sharding, simhash_dedup
from ledgerline.llm.common import table, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group of near-duplicates."""
    return simhash_dedup.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.shard(docs)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier, the fingerprints and the label propagation are not expressible in SQL; the
# tests hold every stage against a brute-force version.
ORACLE_SQL = None
