"""Bounded training samples for the classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the documents whose label may be learnt: null labels and held-out ids are
    left out; a doc_id with several labels counts once, with the smallest."""
    y = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
         .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))
    return docs.select("doc_id").distinct().join(y, "doc_id")


def smallest_hashes(ids: DataFrame, limit: int, seed: int, tag: Column) -> DataFrame:
    """``limit`` ids by the order of a hash, with ``tag`` as column ``y``."""
    return (ids.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(limit)
            .select("doc_id", tag.alias("y")))


def sample_rows(docs: DataFrame, picks: list[DataFrame], limits: list[int]) -> DataFrame:
    """(text, y, h) of the picked documents, at most ``limits`` rows of each pick, in the order of a
    hash ``h``. Equal texts of an id count once, so an id that many rows share neither fills the
    sample nor reaches the driver whole. The picks are limited in number, so they are broadcast."""
    def rows(ids: DataFrame, limit: int) -> DataFrame:
        found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").withColumn("d", F.xxhash64("text"))
        found = found.groupBy("doc_id", "d", "y").agg(F.first("text").alias("text"))
        h = F.xxhash64("doc_id", "d", F.lit(11))
        return found.select("text", "y", h.alias("h")).orderBy("h").limit(limit)
    return reduce(DataFrame.unionByName, (rows(*x) for x in zip(picks, limits)))
