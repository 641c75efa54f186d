"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import work_path

# A word is a run of characters other than blank, tab, newline, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared checkpoint folder, read it back."""
    spark = df.sparkSession
    path = work_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own(df: DataFrame, c: str) -> Column:
    """Column ``c`` of ``df`` itself, whatever characters its name has."""
    return df["`" + c.replace("`", "``") + "`"]


def with_score(docs: DataFrame, score, out: str) -> DataFrame:
    """``docs`` with the double column ``out``: ``score()`` is made once per task and turns the
    texts of a batch (an Arrow array) into as many numbers. Columns travel under plain names."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"

    def run(batches):
        scorer = score()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scorer(batch.column(text)), pa.float64())],
                                             names=[*batch.schema.names, "score"])
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*names, out)


SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, narrow rows whose number was counted, marked for broadcast up to a fixed bound."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def word_count(text: Column) -> Column:
    """Words in the whole text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learnt from (a null id is held out)."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(True))


PREFIX_ROWS = 4096


def totals_before(sums: DataFrame, group: list[str], b: str, out: str, buckets: int) -> DataFrame:
    """(group, b, out): the total of ``__sum`` over the group's smaller ``b``, in windows of at
    most ``PREFIX_ROWS`` rows."""
    coarse = f"{b}_" if buckets > PREFIX_ROWS else None
    within = [*group, coarse] if coarse else group
    if coarse:
        sums = sums.withColumn(coarse, F.floor(F.col(b) / PREFIX_ROWS))
    before = Window.partitionBy(*within).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    inner = sums.select(*within, b, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias(out))
    if not coarse:
        return inner
    above = f"{out}_"
    upper = totals_before(sums.groupBy(*within).agg(F.sum("__sum").alias("__sum")), group, coarse, above,
                           buckets // PREFIX_ROWS + 1)
    return inner.join(upper, within).select(*group, b, (F.col(out) + F.col(above)).alias(out))


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
                  spread: Column, buckets: int) -> DataFrame:
    """Inclusive running total of ``value`` inside each group, in the order
    (``bucket``, ``order``), without one task per group.

    ``spread`` is an evenly spread non-negative long per row; rows go to ``pmod(spread,
    buckets)``. Bucket sums are pre-aggregated, their prefix is taken over the table of buckets
    (itself in coarser buckets when there are many), and each window holds the rows of one
    bucket of one group. With ``value`` 1 the
    total is a rank from 1. Ties in ``order`` are broken arbitrarily among equal rows.
    """
    b, base = "__bucket", "__base"
    df = df.withColumn(b, F.pmod(spread, F.lit(buckets)))
    sums = totals_before(df.groupBy(*group, b).agg(F.sum(value).alias("__sum")), group, b, base, buckets)
    w = (Window.partitionBy(*group, b).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.join(sums, [*group, b])
            .withColumn(out, F.col(base) + F.sum(value).over(w))
            .drop(b, base))
