"""Command-line jobs (``spark-submit --py-files ledgerline.zip
ledgerline/cli.py ...`` or ``python -m ledgerline.cli ...``).

* ``warehouse`` — one daily run staging -> core -> marts over six source
  tables stored as Parquet directories ``{sources}/{customer,city,state,
  branch,account,transaction}`` (columns as in ``schemas.STAGING_TABLES``
  plus ``dtmupd``) and the transaction files under ``--files``, into
  versioned tables under ``--base``;
* ``ingest-files`` — take every new CSV file under a drop folder once
  (stream with ``Trigger.AvailableNow``) into staged transactions, rejects
  and the incremental daily summary;
* ``bronze`` — land the last five sessions of daily bars for a ticker list
  as one snapshot (``Company``/``snapshot_ts`` partitions), with rejects
  and a run log;
* ``banks`` — take the banks table (``Rank, Country, MC_USD_Billion``) from
  HTML pages (Parquet: ``page_id, html``) or as it is (Parquet), convert it
  with a rate CSV, write CSV + table + run log.

The session comes from the submitting environment; only settings that the
results depend on are set here when missing.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from ledgerline.schemas import STAGING_TABLES


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("ledgerline").getOrCreate()
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static") != "dynamic":
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def cmd_warehouse(spark: SparkSession, a: argparse.Namespace) -> dict:
    from ledgerline.plans.warehouse_run import run_all

    sources = {s.name: spark.read.parquet(f"{a.sources.rstrip('/')}/{s.name}")
               for s in STAGING_TABLES}
    return run_all(spark, sources, a.base, a.batch_ts, a.files)


def cmd_ingest_files(spark: SparkSession, a: argparse.Namespace) -> dict:
    from ledgerline.streaming.file_ingest import run_file_ingest

    run_file_ingest(spark, a.glob, a.out, a.checkpoint, a.batch_ts,
                    max_files_per_trigger=a.max_files)
    return {"staged": f"{a.out}/staged", "rejects": f"{a.out}/rejects",
            "rejected_files": f"{a.out}/rejected_files", "daily_summary": f"{a.out}/daily_summary"}


def cmd_banks(spark: SparkSession, a: argparse.Namespace) -> dict:
    from ledgerline.operators import fx
    from ledgerline.plans.banks_run import run_banks
    from ledgerline.sources import html

    banks = html.banks(spark.read.parquet(a.pages)) if a.pages else spark.read.parquet(a.banks)
    run_banks(spark, banks, fx.read_rates(spark, a.rates), a.out, a.run_id, a.batch_ts)
    return {"table": f"{a.out}/banks_table", "csv": f"{a.out}/banks_csv",
            "run_log": f"{a.out}/run_log"}


def cmd_bronze(spark: SparkSession, a: argparse.Namespace) -> dict:
    from ledgerline.operators import bronze
    from ledgerline.plans.bronze_run import run_bronze

    bars = spark.read.parquet(a.bars)
    tickers = bronze.tickers_frame(spark, [t for t in a.tickers.split(",") if t])
    return run_bronze(spark, bars, tickers, a.out, a.batch_ts)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="cmd", required=True)
    w = sub.add_parser("warehouse")
    w.add_argument("--sources", required=True)
    w.add_argument("--base", required=True)
    w.add_argument("--files", help="folder of CSV and Excel transaction files, each taken once")
    w.add_argument("--batch-ts", required=True, help="yyyy-MM-dd HH:mm:ss")
    f = sub.add_parser("ingest-files")
    f.add_argument("--glob", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--batch-ts", required=True)
    f.add_argument("--max-files", type=int, default=1000)
    b = sub.add_parser("banks")
    source = b.add_mutually_exclusive_group(required=True)
    source.add_argument("--banks")
    source.add_argument("--pages")
    b.add_argument("--rates", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--run-id", default="banks")
    b.add_argument("--batch-ts", required=True)
    z = sub.add_parser("bronze")
    z.add_argument("--bars", required=True, help="Parquet: Company, Date, Open..Volume")
    z.add_argument("--tickers", required=True, help="comma-separated")
    z.add_argument("--out", required=True)
    z.add_argument("--batch-ts", required=True)
    a = p.parse_args(argv)
    spark = _session()
    handler = {"warehouse": cmd_warehouse, "ingest-files": cmd_ingest_files,
               "banks": cmd_banks, "bronze": cmd_bronze}[a.cmd]
    print(json.dumps(handler(spark, a)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
