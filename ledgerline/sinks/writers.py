"""Writers: Parquet parts, table replace, CSV, run log, namespaces.

Writes go to paths the caller names (on a cluster: a shared file system or
object store). A replaced table is written to a new version directory and
only then published, so readers never see a half-written or empty table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import FORMAT_LOG, ntz


def write_parquet_parts(df: DataFrame, path: str, max_records: int = 10_000,
                        mode: str = "overwrite") -> str:
    """Snappy Parquet with at most ``max_records`` rows per file (the
    reference's 10 000-row spool chunks)."""
    (df.write.mode(mode).option("compression", "snappy")
       .option("maxRecordsPerFile", max_records).parquet(path))
    return path


def version_name(stamp: str = "") -> str:
    """``v_[{batch stamp}_]{write time ns}_{id}``: sorts by batch, then by write time,
    so a re-run of the same batch supersedes the earlier one."""
    return f"v_{stamp + '_' if stamp else ''}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, base: str) -> str | None:
    """Path of the latest committed (``_SUCCESS``) version under ``base``, if any."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(base)):
        return None
    names = sorted((st.getPath().getName() for st in fs.listStatus(path(base))
                    if st.getPath().getName().startswith("v_")), reverse=True)
    return next((f"{base}/{n}" for n in names if fs.exists(path(f"{base}/{n}/_SUCCESS"))), None)


def publish_version(df: DataFrame, base: str, stamp: str = "") -> str:
    """Full replace: write a fresh version directory under ``base`` and return it. It
    becomes the current one when Spark commits it; the previous one stays readable."""
    path = f"{base.rstrip('/')}/{version_name(stamp)}"
    df.write.mode("errorifexists").parquet(path)
    return path


def replace_table(spark: SparkSession, df: DataFrame, base: str) -> DataFrame:
    """``to_sql(if_exists='replace')``: new version, read back as any later reader would."""
    publish_version(df, base)
    return spark.read.parquet(current_version(spark, base.rstrip("/")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with a header row, no index column."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


RUN_LOG_SCHEMA = "run_id string, seq int, stage string, ts timestamp_ntz, message string, rows long"


def log_line(ts_col: str = "ts", message_col: str = "message", fmt: str = FORMAT_LOG):
    """``"{timestamp} : {message}"`` in the log's time format."""
    return F.concat(F.date_format(ts_col, fmt), F.lit(" : "), F.col(message_col))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the observation that counts its rows (``["rows"]``) while an action runs over it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_run_log(spark: SparkSession, path: str, run_id: str, seq: int, stage: str,
                   ts: str, message: str, rows: int | None = None) -> None:
    """Append one stage record; ``rows`` is the stage's row count, if it has one."""
    rec = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(seq).alias("seq"),
                                F.lit(stage).alias("stage"), ntz(ts).alias("ts"),
                                F.lit(message).alias("message"),
                                F.lit(rows).cast("long").alias("rows"))
    rec.coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path)


def ensure_namespaces(spark: SparkSession, names: Sequence[str] = ("staging", "core", "mart")) -> list[str]:
    """``CREATE SCHEMA`` for each layer; returns the catalog's databases."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")
    return sorted(d.name for d in spark.catalog.listDatabases())


def register_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and register it as the external table ``namespace.table``; a
    table of that name is not replaced."""
    df.write.mode("errorifexists").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
