"""The stock bronze run: for a ticker list, land the last five sessions of
daily bars as one snapshot per run (partitioned by company and snapshot
time), record tickers without data, and log the run's stages.

All tickers are one Spark job (the reference loops over tickers); a ticker
without data does not stop the others, it lands in the reject set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import bronze
from ledgerline.sinks import writers

# Stages of the stock run log and their messages.
STAGES = (
    ("pipeline_start", "ETL Pipeline Start"),
    ("ingestion_start", "Ingestion Start"),
    ("ingestion_end", "Ingestion End"),
    ("pipeline_end", "ETL Pipeline Complete"),
)
SESSIONS = 5


def run_bronze(spark: SparkSession, bars: DataFrame, tickers: DataFrame, out_dir: str,
               batch_ts: str, run_id: str = "bronze") -> dict[str, str]:
    """Land one snapshot; returns the paths written."""
    log = f"{out_dir}/run_log"
    msg = dict(STAGES)

    def step(seq: int, stage: str, rows: int | None = None) -> None:
        writers.append_run_log(spark, log, run_id, seq, stage, batch_ts, msg[stage], rows)

    step(1, "pipeline_start")
    step(2, "ingestion_start")
    landed, landed_rows = writers.counted(bronze.last_sessions(bronze.for_tickers(bars, tickers), SESSIONS))
    bronze.write_bronze(landed, f"{out_dir}/bronze", batch_ts)
    missing = bronze.missing_tickers(bars, tickers).withColumn(
        "snapshot_ts", bronze.snapshot_stamp(batch_ts))
    (missing.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_ts").parquet(f"{out_dir}/rejects"))
    step(3, "ingestion_end", landed_rows.get["rows"])
    step(4, "pipeline_end")
    return {"bronze": f"{out_dir}/bronze", "rejects": f"{out_dir}/rejects", "run_log": log}
