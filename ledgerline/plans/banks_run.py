"""The banks run: extract -> convert -> CSV + table -> three queries, with
a stage log appended after every step (the steps that happen here: there is no
database server to connect to).

Row counts in the log are observed by the writes themselves: the CSV write counts the rows
extracted, converted and saved in its one pass, the table write those of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import fx
from ledgerline.sinks import writers

# The stages of the banks run log and their messages.
STAGES = (
    ("start", "Preliminaries complete. Initiating ETL process"),
    ("extract", "Data extraction complete. Initiating Transformation process"),
    ("transform", "Data transformation complete. Initiating Loading process"),
    ("load_csv", "Data saved to CSV file"),
    ("load_db", "Data loaded to Database as a table, Executing queries"),
    ("done", "Process Complete"),
)


def run_banks(spark: SparkSession, extracted: DataFrame, rates: DataFrame | dict,
              out_dir: str, run_id: str, batch_ts: str) -> dict[str, DataFrame]:
    """Run the banks pipeline; returns the table, the three query results
    and the run log (all as DataFrames over what was written)."""
    log = f"{out_dir}/run_log"
    msg = dict(STAGES)
    seq = iter(range(1, len(STAGES) + 1))

    def step(stage: str, rows: int | None = None) -> None:
        writers.append_run_log(spark, log, run_id, next(seq), stage, batch_ts, msg[stage], rows)

    step("start")
    source, extracted_rows = writers.counted(extracted)
    saved, converted_rows = writers.counted(fx.fx_convert(source, rates))
    writers.write_csv(saved, f"{out_dir}/banks_csv")
    step("extract", extracted_rows.get["rows"])
    step("transform", converted_rows.get["rows"])
    step("load_csv", converted_rows.get["rows"])
    loaded, table_rows = writers.counted(fx.fx_convert(extracted, rates))
    table = writers.replace_table(spark, loaded, f"{out_dir}/banks_table")
    step("load_db", table_rows.get["rows"])
    results = {
        "table": table,
        "select_all": table.select("*"),
        "avg_gbp": fx.average(table, "MC_GBP_Billion", "avg_gbp"),
        "limit5": fx.first_by_rank(table, 5),
    }
    step("done")
    results["run_log"] = writers.read_run_log(spark, log).withColumn("line", writers.log_line())
    return results
