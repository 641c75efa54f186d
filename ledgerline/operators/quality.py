"""Data-quality checks: the constraints the reference declares in DDL
(primary keys, foreign keys, NOT NULL, VARCHAR lengths) and the reject
sets of its loaders, as DataFrames of violations.

Every check is one pass: counts are aggregated map-side, never collected
row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count ``n_rows``.
    A null key is a violation as well (primary keys are NOT NULL)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return g.where((F.col("n_rows") > 1) | null_key)


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                  name: str) -> DataFrame:
    """Child key values with no parent row: ``(constraint_name, key_value,
    n_rows)``. Null foreign keys are allowed (SQL semantics)."""
    parents = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull())
    orphans = child.where(F.col(fk).isNotNull()).join(
        parents, F.col(fk) == F.col("__pk"), "left_anti")
    return (orphans.groupBy(F.col(fk).cast("bigint").alias("key_value"))
                   .agg(F.count(F.lit(1)).alias("n_rows"))
                   .select(F.lit(name).alias("constraint_name"), "key_value", "n_rows"))


def not_null_violations(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Per column, the number of null values: ``(table_name, column_name,
    n_null)`` (one row per column, zero included)."""
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                   for c in columns])
    long = agg.unpivot([], list(columns), "column_name", "n_null")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.coalesce(F.col("n_null"), F.lit(0).cast("bigint")).alias("n_null"))


def length_violations(df: DataFrame, limits: dict[str, int], table: str) -> DataFrame:
    """Per text column with a declared limit: rows that exceed it and the
    longest value length: ``(table_name, column_name, max_allowed,
    n_too_long, max_length)``."""
    cols = list(limits)
    aggs = []
    for c in cols:
        aggs.append(F.sum(F.when(F.length(c) > limits[c], 1).otherwise(0)).cast("bigint")
                    .alias(f"{c}__n"))
        aggs.append(F.max(F.length(c)).cast("int").alias(f"{c}__m"))
    a = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(limits[c]).alias("max_allowed"),
                     F.col(f"{c}__n").alias("n_too_long"), F.col(f"{c}__m").alias("max_length"))
            for c in cols]
    return (a.select(F.explode(F.array(*rows)).alias("r"))
             .select(F.lit(table).alias("table_name"), "r.*"))


def key_summary(table: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(table_name, n_duplicate_keys, n_null_keys)`` for a declared primary key."""
    v = pk_violations(df, keys)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return v.agg(F.count(F.when(~null_key, 1)).alias("n_duplicate_keys"),
                 F.coalesce(F.sum(F.when(null_key, F.col("n_rows"))), F.lit(0)).cast("bigint")
                 .alias("n_null_keys")).select(F.lit(table).alias("table_name"), "*")


def reference_summary(name: str, child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row ``(constraint_name, n_keys, n_rows)`` for a declared foreign key."""
    v = fk_violations(child, fk, parent, pk, name)
    return v.agg(F.count(F.lit(1)).alias("n_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
                 .alias("n_rows")).select(F.lit(name).alias("constraint_name"), "*")


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reject_reason``: the first rule (name, bad-row condition) that
    a row breaks, null for good rows. One pass; split with ``where``."""
    reason = F.lit(None).cast("string")
    for name, bad in reversed(list(rules)):
        reason = F.when(F.coalesce(bad, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def with_default(df: DataFrame, col: str, default: Column) -> DataFrame:
    """Column default (``DEFAULT GETDATE()``): fill nulls with the value."""
    return df.withColumn(col, F.coalesce(F.col(col), default))
