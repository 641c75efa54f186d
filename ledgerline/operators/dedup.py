"""Keep one row per key: latest version first, fixed tie-break.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1`` is the reference's
form. Catalyst turns a ``row_number`` filtered to 1 into a partial
``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row per
map task before it is exchanged; the final window then sees at most one row
per key and input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: str | Sequence[str],
                   order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row in ``order``.

    ``order`` must be a total order within a key (add tie-break columns);
    a bare ``dropDuplicates`` would keep an arbitrary row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .drop("__rn"))


def latest_transaction_order() -> list[Column]:
    """Order of versions of one transaction: newest date first, then the
    larger amount, then the smaller branch id, then the type (our
    tie-break; the reference leaves ties open)."""
    return [F.col("transaction_date").desc_nulls_last(),
            F.col("amount").desc_nulls_last(),
            F.col("branch_id").asc_nulls_first(),
            F.col("transaction_type").asc_nulls_first()]


def staged_row_order(value_cols: Sequence[str]) -> list[Column]:
    """Order of staged copies of one key: latest load, latest create, then
    all value columns (descending) so the choice is fixed."""
    return ([F.col("dtmload").desc_nulls_last(), F.col("dtmcrt").desc_nulls_last()]
            + [F.col(c).desc_nulls_last() for c in value_cols])
