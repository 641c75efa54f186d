"""Tables laid out by a key, so that merges on it do not move them.

A bucketed table keeps the rows of a key's hash in one bucket, sorted by the key. A merge or a
new-key test on that key then shuffles the day's changes to the buckets and joins bucket by
bucket; the table itself, however large, is read where it lies and never exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_BUCKET = 5_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets that hold about ``ROWS_PER_BUCKET`` rows each; a power of two, so that tables of
    different sizes have bucket counts that divide each other."""
    n = least
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as the external table ``name``, bucketed and sorted by ``key``: one
    file for each bucket. A table of that name is not replaced."""
    (df.repartition(buckets, key).write.mode("errorifexists").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)
