"""Transaction files: CSV directories (Excel workbooks via ``sources.xlsx``)
with a per-file header check and reject sets.

* The header of a file is its first non-blank line. One scan of the text
  lines takes it: the line with the smallest row id among the lines of the
  file's first split, found by one aggregate of that same scan.
* The header table (one row per file: positions of the required columns,
  names that are missing) is written once. A header cell without a name (the
  index column of a saved data frame, a gap in the middle) keeps its place, so
  the columns after it keep theirs. The table also tells how wide the widest
  file is, so the data scan's schema has as many columns as are needed,
  however many that is.
* The data scan lets the CSV reader drop each file's header line, meets its
  file's header row by path, and picks the required columns by position:
  reordered and extra columns load correctly. Columns that no file has a
  required one at are not cut out of the lines.
* A file without every required column, or without any line, is rejected as a
  whole; a row whose date does not parse is rejected alone.

File names are taken literally: blanks, brackets and signs of patterns in them
have no meaning. ``file_path`` is the name as Spark's metadata gives it (URL
encoded); ``list_files`` also gives the plain name as ``path``.

Quotes are doubled inside quoted fields. A quoted field may hold line breaks
only with ``multi_line=True``; such files are not split, so the default reads
one record per line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.dates import ntz, with_mixed_dates
from ledgerline.functions.text import safe_double, safe_long, trim_ws
from ledgerline.operators.joins import small
from ledgerline.schemas import REQUIRED_FILE_COLUMNS
from ledgerline.session import work_path

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
REJECTED_FILES = "file_path string, reject_reason string, n_rows long"


def wide_strings(n: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(n)])


def _load(spark: SparkSession, fmt: str, paths: Sequence[str], glob: str, **options) -> DataFrame:
    reader = spark.read.format(fmt).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(list(paths))


def literal_path(path: str) -> str:
    """``path`` for a reader that takes patterns, so that it means this one file."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, paths: Sequence[str], glob: str = "*.csv") -> DataFrame:
    """``(file_path, path, modified, length)`` of the files, from the listing alone."""
    return _load(spark, "binaryFile", paths, glob).select(
        F.col("_metadata.file_path").alias("file_path"), "path", F.col("modificationTime").alias("modified"), "length")


def column_positions(header: Column, required: Sequence[str]) -> list[Column]:
    """``pos`` (1-based position of each required name, 0 if absent) and ``missing``."""
    return [F.array(*[F.array_position(header, c).cast("int") for c in required]).alias("pos"),
            F.array_except(F.array(*[F.lit(c) for c in required]), header).alias("missing")]


def header_table(spark: SparkSession, paths: Sequence[str], required: Sequence[str]) -> tuple[DataFrame, int, int]:
    """(``file_path, pos, missing``, number of files, columns of the widest file)."""
    bom = F.col("value").startswith("\ufeff")
    line = F.when(bom, F.substr("value", F.lit(2))).otherwise(F.col("value"))
    # the lines of later splits are dropped before anything is made of them
    lines = _load(spark, "text", paths, "*.csv").where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("file_path"), line.alias("line")).where(F.trim("line") != "")
    first = (lines.withColumn("rid", F.monotonically_increasing_id())
             .groupBy("file_path").agg(F.min(F.struct("rid", "line")).alias("first"))
             .select("file_path", F.col("first.line").alias("line"),
                     F.size(F.split("first.line", ",", -1)).alias("width")))
    path = work_path(spark, "file-headers")
    first.write.parquet(path)
    first = spark.read.schema(first.schema).parquet(path)
    n_files, width = first.agg(F.count(F.lit(1)), F.coalesce(F.max("width"), F.lit(1))).first()
    cells = F.from_csv("line", F.lit(", ".join(f"_c{i} string" for i in range(width))), CSV_OPTIONS)
    # a cell without a name stays as '', which no required name equals
    header = F.transform(F.array(*[cells[f"_c{i}"] for i in range(width)]), lambda x: trim_ws(F.coalesce(x, F.lit(""))))
    table = first.select("file_path", header.alias("header")).select(
        "file_path", *column_positions(F.col("header"), required))
    return table, n_files, width


def pick(data: DataFrame, required: Sequence[str]) -> DataFrame:
    """``data`` (``file_path, cells, pos``) with the required columns by name."""
    return data.select("file_path", *[F.when(F.get("pos", F.lit(i)) > 0, F.get("cells", F.get("pos", F.lit(i)) - 1)).alias(c)
                                      for i, c in enumerate(required)])


def missing_text() -> Column:
    return F.concat(F.lit("missing columns: "), F.array_join("missing", ", "))


def typed(picked: DataFrame, batch_ts: str, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of ``split_typed``, of rows typed once and kept under ``path``."""
    rows = with_mixed_dates(picked, "transaction_date", "__parsed").select(
        "file_path",
        safe_long("transaction_id").alias("transaction_id"),
        safe_long("account_id").alias("account_id"),
        F.col("__parsed").alias("transaction_date"),
        F.col("transaction_date").alias("__date_text"),
        safe_double("amount").alias("amount"),
        "transaction_type",
        safe_long("branch_id").alias("branch_id"),
    )
    # files are parsed once: good and rejected rows are both read from the typed rows
    path = path or work_path(picked.sparkSession, "typed-rows")
    rows.write.parquet(path)
    return split_typed(picked.sparkSession.read.schema(rows.schema).parquet(path), batch_ts)


def split_typed(rows: DataFrame, batch_ts: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows): typed columns, ``dtmcrt`` = the transaction's date and
    ``dtmload`` = ``batch_ts``; rows whose date does not parse have ``reject_reason``."""
    good = (rows.where(F.col("transaction_date").isNotNull()).drop("__date_text")
            .withColumn("dtmcrt", F.col("transaction_date")).withColumn("dtmload", ntz(batch_ts)))
    bad = rows.where(F.col("transaction_date").isNull()).withColumn("reject_reason", F.lit("invalid_date"))
    return good, bad


def ingest_csv(spark: SparkSession, paths: Sequence[str], batch_ts: str,
               required: Sequence[str] = REQUIRED_FILE_COLUMNS,
               multi_line: bool = False, typed_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Load the CSV files under ``paths`` (directories or files): ``(good rows, rejected rows,
    rejected files)``; rejected files are ``file_path, reject_reason, n_rows``. The typed rows are
    kept under ``typed_path`` (a new folder without it)."""
    headers, n_files, width = header_table(spark, paths, required)
    # at most as many places as the widest file has columns
    places = sorted(r["place"] for r in headers.select(F.explode("pos").alias("place")).distinct().collect() if r["place"])
    among = F.array(*map(F.lit, places)).cast("array<int>")
    headers = headers.withColumn("pos", F.transform("pos", lambda p: F.array_position(among, p).cast("int")))
    reader = spark.read.schema(wide_strings(width)).options(**CSV_OPTIONS)
    lines = (reader.option("header", True).option("multiLine", multi_line)
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(list(paths)))
    data = lines.select(F.col("_metadata.file_path").alias("file_path"),
                        F.array(*[f"_c{p - 1}" for p in places]).cast("array<string>").alias("cells"))
    complete = F.size("missing") == 0
    good, bad = typed(pick(data.join(small(headers.where(complete), n_files), "file_path"), required), batch_ts, typed_path)
    incomplete = headers.where(~complete)
    counted = data.select("file_path").join(small(incomplete, n_files).select("file_path"), "file_path") \
        .groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    listed = list_files(spark, paths).select("file_path")
    rejected = (incomplete.join(counted, "file_path", "left")
                .select("file_path", missing_text().alias("reject_reason"),
                        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))
                .unionByName(listed.join(headers.select("file_path"), "file_path", "left_anti")
                             .select("file_path", F.lit("no header line").alias("reject_reason"),
                                     F.lit(0).cast("long").alias("n_rows"))))
    return good, bad, rejected


def ingest_csv_dir(spark: SparkSession, path: str, batch_ts: str, **options):
    """Batch load of every CSV file under ``path`` (see ``ingest_csv``)."""
    return ingest_csv(spark, [path], batch_ts, **options)
