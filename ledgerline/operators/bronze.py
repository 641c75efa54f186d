"""Bronze layer of daily price bars: last sessions per company, tickers
with no data, partitioned snapshot writes.

The reference fetches five days of bars per ticker in a loop; here all
tickers are one job. Bars are aggregated per (company, day) with partial
aggregation first, so even a company holding a third of all ticks becomes
one row per day before any window runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import FORMAT_SNAPSHOT, ntz
from ledgerline.functions.text import object_path

BAR_COLUMNS = ("Company", "Date", "Open", "High", "Low", "Close", "Volume")


def daily_bars(ticks: DataFrame, company: str, ts: str, price: str, tie: str) -> DataFrame:
    """OHLC + count per company and day from tick rows. ``tie`` (an integer)
    breaks equal timestamps for open/close.

    The order of ticks is one fixed-width number - microseconds of the day,
    then the tie - so the whole aggregate runs by hash, without a sort.
    """
    number = lambda c: c.cast("decimal(20,0)")
    micros = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1_000_000 \
        + (F.date_part(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")
    order = (number(micros).cast("decimal(38,0)") * F.lit(str(10 ** 19)).cast("decimal(20,0)")
             + number(F.col(tie)) + F.lit(str(2 ** 63)).cast("decimal(20,0)")).cast("decimal(38,0)")
    return (ticks.groupBy(F.col(company).alias("Company"), F.to_date(ts).alias("Date"))
                 .agg(F.min_by(price, order).alias("Open"), F.max(price).alias("High"),
                      F.min(price).alias("Low"), F.max_by(price, order).alias("Close"),
                      F.count(F.lit(1)).alias("Volume")))


def bars_from_events(events: DataFrame) -> DataFrame:
    """Test stand-in: event type = company, event value = price."""
    return daily_bars(events, "event_type", "ts", "value", "event_id")


def tickers_frame(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in tickers], "Company string")


def last_sessions(bars: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` trading days of each company (``period='5d'``)."""
    w = Window.partitionBy("Company").orderBy(F.col("Date").desc())
    return (bars.withColumn("__rn", F.row_number().over(w))
                .where(F.col("__rn") <= n).drop("__rn")
                .select(*BAR_COLUMNS))


def for_tickers(bars: DataFrame, tickers: DataFrame) -> DataFrame:
    """Bars of the requested tickers only (semi join with the
    ticker list)."""
    return bars.join(tickers.select("Company").distinct(), "Company", "left_semi")


def missing_tickers(bars: DataFrame, tickers: DataFrame,
                    reason: str = "no data returned") -> DataFrame:
    """Requested tickers without any bar: the reject set of the ingest."""
    have = bars.select("Company").distinct()
    return (tickers.select("Company").distinct()
                   .join(have, "Company", "left_anti")
                   .withColumn("reject_reason", F.lit(reason)))


def snapshot_stamp(batch_ts: str):
    return F.date_format(ntz(batch_ts), FORMAT_SNAPSHOT)


def with_snapshot(bars: DataFrame, batch_ts: str) -> DataFrame:
    return bars.withColumn("snapshot_ts", snapshot_stamp(batch_ts))


def write_bronze(bars: DataFrame, path: str, batch_ts: str) -> None:
    """Write one snapshot: ``{path}/Company=../snapshot_ts=../part-*.parquet``. Other
    snapshots are never touched; the same batch written again replaces its own."""
    (with_snapshot(bars, batch_ts).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Company", "snapshot_ts").parquet(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    schema = ("Date date, Open double, High double, Low double, Close double, "
              "Volume long, Company string, snapshot_ts string")
    return spark.read.schema(schema).parquet(path)


def latest_snapshot_per_day(bronze: DataFrame) -> DataFrame:
    """One bar per (company, day): the newest snapshot wins (daily runs of
    a 5-day window store each bar up to five times)."""
    w = Window.partitionBy("Company", "Date").orderBy(F.col("snapshot_ts").desc())
    return (bronze.withColumn("__rn", F.row_number().over(w))
                  .where(F.col("__rn") == 1).drop("__rn"))


def object_paths(bars: DataFrame, stamp_col: str, prefix: str = "bronze") -> DataFrame:
    """Object name per company snapshot: ``bronze/{c}/{c}_{yyyyMMdd_HHmmss}.parquet``."""
    return bars.select("Company", object_path(prefix, F.col("Company"),
                                              F.date_format(stamp_col, FORMAT_SNAPSHOT))
                       .alias("object_path"))
