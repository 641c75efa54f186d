"""Join helpers: bounded broadcast sides, NOT-IN style anti join, semi join.

A side is hinted for broadcast only when its size is bounded by construction
(the calendar) or its rows were counted (``small``). Every other join is left
to Catalyst and AQE, which decide from file sizes and run-time shuffle sizes;
asking the optimizer for an estimate at every join would cost more than the
small joins themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows up to which a counted, narrow side is broadcast.
SMALL_ROWS = 100_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, whose rows were counted, as a broadcast side up to ``SMALL_ROWS``."""
    return F.broadcast(df) if rows <= SMALL_ROWS else df


def calendar(dim_date: DataFrame, day: str, key: str) -> DataFrame:
    """``(day, key)`` of the date dimension as a broadcast side: one narrow row
    per day, so at most the days of the calendar whatever the data's size."""
    return F.broadcast(dim_date.select(F.col("FullDate").alias(day), F.col("DateID").alias(key)))


def anti_new_keys(rows: DataFrame, target: DataFrame, key: str,
                  target_key: str | None = None) -> DataFrame:
    """Rows whose key is not in ``target`` (``key NOT IN (SELECT ...)``).

    SQL ``NOT IN`` never returns a null key, so null keys are dropped here
    (they belong to the reject set). Target keys are primary keys and never
    null, so a plain ``left_anti`` equals ``NOT IN`` on the rest. Spark's
    null-aware ``NOT IN`` plan would broadcast the target; this is an
    ordinary anti join instead.
    """
    tk = target_key or key
    keys = target.select(F.col(tk).alias("__k")).where(F.col("__k").isNotNull())
    return rows.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("__k"), "left_anti")


def semi_keys(rows: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose ``key`` exists in ``parent`` (inner-join filter without fan-out)."""
    keys = parent.select(F.col(parent_key).alias("__pk"))
    return rows.join(keys, F.col(key) == F.col("__pk"), "left_semi")
