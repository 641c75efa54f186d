"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every entry reads the driver's test tables (through ``plans.adapter``) and
builds a lazy plan; the driver collects it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import (FORMAT_COMPACT, FORMAT_ISO_SECONDS, FORMAT_LOG,
                                        FORMAT_SNAPSHOT, date_id, with_mixed_dates)
from ledgerline.functions.money import signed_amount
from ledgerline.functions.text import collated, drop_last_char, safe_double, safe_long
from ledgerline.operators import bronze, fx, marts, merge, quality
from ledgerline.operators import dimensions as dims
from ledgerline.operators import incremental as inc
from ledgerline.operators.dedup import latest_per_key, latest_transaction_order
from ledgerline.operators.facts import fact_transaction
from ledgerline.plans import adapter, banks_run, bronze_run, scenario, warehouse_run
from ledgerline.schemas import (CORE_NOT_NULL, FOREIGN_KEYS, PRIMARY_KEYS, SPEC_BY_NAME,
                                STAGING_TABLES, VARCHAR_LIMITS)
from ledgerline.session import work_path
from ledgerline.sinks import writers
from ledgerline.sources import files, html, xlsx
from ledgerline.streaming import file_ingest as stream
from ledgerline.streaming import latest_versions

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# --- core first load -------------------------------------------------------

@query("dim_date")
def q_dim_date(spark, sf_dir):
    return scenario.dim_date_for(scenario.raw(spark, sf_dir))


@query("dim_customer")
def q_dim_customer(spark, sf_dir):
    return scenario.first_load(spark, sf_dir).dim_customer


@query("dim_branch")
def q_dim_branch(spark, sf_dir):
    return scenario.first_load(spark, sf_dir).dim_branch


@query("dim_account")
def q_dim_account(spark, sf_dir):
    return scenario.first_load(spark, sf_dir).dim_account


@query("fact_transaction")
def q_fact_transaction(spark, sf_dir):
    return scenario.first_load(spark, sf_dir).fact


# --- marts -----------------------------------------------------------------

@query("customer_mart")
def q_customer_mart(spark, sf_dir):
    core = scenario.first_load(spark, sf_dir)
    return marts.customer_mart(core.dim_customer, core.dim_account, core.fact)


@query("daily_summary")
def q_daily_summary(spark, sf_dir):
    core = scenario.first_load(spark, sf_dir)
    return marts.daily_summary(core.fact, core.dim_date)


# --- merge family: new keys, type-1 updates, dedup -------------------------



B = adapter.BATCH_TS


@query("new_keys_customer")
def q_new_keys_customer(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return dims.dim_customer(r["customer"], r["city"], r["state"], B, target=ex["DimCustomer"])


@query("new_keys_branch")
def q_new_keys_branch(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return dims.dim_branch(r["branch"], B, target=ex["DimBranch"])


@query("new_keys_account")
def q_new_keys_account(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return dims.dim_account(r["account"], ex["DimDate"], B, target=ex["DimAccount"])


@query("new_keys_fact")
def q_new_keys_fact(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    core = scenario.first_load(spark, sf_dir, raw_tables=r)
    ex = scenario.existing_core(spark, sf_dir, r)
    return fact_transaction(r["transaction"], core.dim_account, core.dim_branch,
                            core.dim_date, B, target=ex["FactTransaction"])


@query("merge_type1_customer")
def q_merge_customer(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return merge.update_dim_customer(ex["DimCustomer"], r["customer"], r["city"], r["state"], B,
                                     scenario.EXISTING_MARK)


@query("merge_type1_branch")
def q_merge_branch(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return merge.update_dim_branch(ex["DimBranch"], r["branch"], B, scenario.EXISTING_MARK)


@query("merge_type1_account")
def q_merge_account(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return merge.update_dim_account(ex["DimAccount"], r["account"], B, scenario.EXISTING_MARK)


@query("merge_type1_fact")
def q_merge_fact(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return merge.update_fact_transaction(ex["FactTransaction"], r["transaction"], B,
                                         scenario.EXISTING_MARK)


def _bucketed_fact(spark, existing):
    """The existing fact as a table of its own, bucketed by the transaction id."""
    from ledgerline.sinks.bucketed import save_bucketed
    from ledgerline.sinks.writers import ensure_namespaces

    namespace = f"core_{uuid.uuid4().hex[:8]}"
    ensure_namespaces(spark, (namespace,))
    return save_bucketed(existing["FactTransaction"], f"{namespace}.fact_transaction",
                         work_path(spark, "bucketed"), "TransactionID", 16)


@query("new_keys_fact_bucketed")
def q_new_keys_fact_bucketed(spark, sf_dir):
    """New fact rows against a fact that lies bucketed by its key and is not moved."""
    r = scenario.raw(spark, sf_dir)
    core = scenario.first_load(spark, sf_dir, raw_tables=r)
    fact = _bucketed_fact(spark, scenario.existing_core(spark, sf_dir, r))
    return fact_transaction(r["transaction"], core.dim_account, core.dim_branch, core.dim_date, B, target=fact)


@query("merge_type1_fact_bucketed")
def q_merge_fact_bucketed(spark, sf_dir):
    """The type-1 merge into a fact that lies bucketed by its key and is not moved."""
    r = scenario.raw(spark, sf_dir)
    fact = _bucketed_fact(spark, scenario.existing_core(spark, sf_dir, r))
    return merge.update_fact_transaction(fact, r["transaction"], B, scenario.EXISTING_MARK)


@query("merge_type1_customer_orphans")
def q_merge_customer_orphans(spark, sf_dir):
    """Changed customers whose city is missing keep their row."""
    r = scenario.raw(spark, sf_dir)
    ex = scenario.existing_core(spark, sf_dir, r)
    return merge.update_dim_customer(ex["DimCustomer"], r["customer"], adapter.cities_with_orphans(r["city"]),
                                     r["state"], B, scenario.EXISTING_MARK)


@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    t = scenario.raw(spark, sf_dir)["transaction"]
    return latest_per_key(t, "transaction_id", latest_transaction_order())


@query("dedup_by_key")
def q_dedup_by_key(spark, sf_dir):
    return dims.latest_staged(scenario.raw(spark, sf_dir)["transaction"], "transaction_id")


@query("core_run")
def q_core_run(spark, sf_dir):
    return scenario.core_run_counts(spark, sf_dir)


@query("stage_counts")
def q_stage_counts(spark, sf_dir):
    core = scenario.first_load(spark, sf_dir)
    parts = [(n, df) for n, df in (("DimDate", core.dim_date), ("DimCustomer", core.dim_customer),
                                   ("DimBranch", core.dim_branch),
                                   ("DimAccount", core.dim_account),
                                   ("FactTransaction", core.fact))]
    out = None
    for n, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


@query("signed_amount")
def q_signed_amount(spark, sf_dir):
    f = scenario.first_load(spark, sf_dir).fact
    return f.select("TransactionID", "TransactionType", "Amount",
                    signed_amount("TransactionType", "Amount").alias("SignedAmount"))


@query("balance_per_customer")
def q_balance_per_customer(spark, sf_dir):
    return marts.balance_per_customer(q_customer_mart(spark, sf_dir), "Customer#000000007")


@query("daily_summary_range")
def q_daily_summary_range(spark, sf_dir):
    return marts.daily_summary_range(q_daily_summary(spark, sf_dir), "19970101", "19971231")


@query("balance_per_customer_sql")
def q_balance_per_customer_sql(spark, sf_dir):
    """The stored procedure called by SQL."""
    name = marts.create_balance_per_customer(q_customer_mart(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {name}(:name)", args={"name": "customer#000000007  "})


@query("daily_summary_range_sql")
def q_daily_summary_range_sql(spark, sf_dir):
    """The stored procedure called by SQL."""
    name = marts.create_daily_summary_range(q_daily_summary(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {name}(:lo, :hi)", args={"lo": "19970101", "hi": "19971231"})


@query("daily_summary_range_pruned")
def q_daily_summary_range_pruned(spark, sf_dir):
    """The daily summary of a range from the stored fact, of which only the range's months are read."""
    base = work_path(spark, "warehouse")
    warehouse_run.run_all(spark, adapter.source_tables(spark, sf_dir), base, B)
    shape = scenario.first_load(spark, sf_dir).fact
    return marts.daily_range_of_fact(warehouse_run.read_fact_by_month(spark, base, shape),
                                     warehouse_run.read_table(spark, base, "core/DimDate"), "19970101", "19971231")


@query("collated_balances")
def q_collated_balances(spark, sf_dir):
    """Balances by customer name where types and names are spelled in several ways (case, trailing
    blanks): sums by type and joins by name follow the collation."""
    core = scenario.first_load(spark, sf_dir)
    spelled = core.fact.withColumn("TransactionType", F.when(F.col("TransactionID") % 3 == 0, F.lower("TransactionType"))
                                   .when(F.col("TransactionID") % 3 == 1, F.concat("TransactionType", F.lit("  ")))
                                   .otherwise(F.col("TransactionType")))
    mart = marts.customer_mart(core.dim_customer, core.dim_account, spelled)
    asked = scenario.raw(spark, sf_dir)["customer"].select(
        collated(F.concat(F.lower("customer_name"), F.repeat(F.lit(" "), (F.col("customer_id") % 4).cast("int")))).alias("__name"))
    j = mart.join(asked, collated("CustomerName") == F.col("__name"))
    return j.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n_accounts"),
                                       F.sum("CurrentBalance").cast("decimal(18,2)").alias("balance"))


@query("customer_rejects")
def q_customer_rejects(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    return dims.customer_rejects(r["customer"], adapter.cities_with_orphans(r["city"]), r["state"])


@query("dim_customer_orphans")
def q_dim_customer_orphans(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    return dims.dim_customer(r["customer"], adapter.cities_with_orphans(r["city"]), r["state"], B)


# --- staging family ------------------------------------------------------------

def _src_stg(spark, sf_dir):
    src = adapter.source_tables(spark, sf_dir)
    return src, adapter.staged_before_run(src)


@query("scan_project")
def q_scan_project(spark, sf_dir):
    src = adapter.source_tables(spark, sf_dir)["customer"]
    return src.select(*SPEC_BY_NAME["customer"].columns)


@query("high_water_mark")
def q_high_water_mark(spark, sf_dir):
    _, stg = _src_stg(spark, sf_dir)
    out = None
    for s in STAGING_TABLES:
        m = inc.high_water_mark(stg[s.name]).select(F.lit(s.name).alias("table_name"), "mark")
        out = m if out is None else out.unionByName(m)
    return out


@query("incremental_extract")
def q_incremental_extract(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    spec = SPEC_BY_NAME["transaction"]
    return inc.incremental_extract(src["transaction"], spec, inc.read_mark(stg["transaction"]), B)


@query("incremental_create_only")
def q_incremental_create_only(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    spec = SPEC_BY_NAME["account"]
    mark = inc.read_mark(stg["account"])
    return inc.incremental_extract(src["account"], spec, mark, B, inc.created_since(mark))


@query("incremental_by_day")
def q_incremental_by_day(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    spec = SPEC_BY_NAME["customer"]
    day = inc.read_mark(stg["customer"])[:10].replace("-", "")
    return inc.incremental_extract(src["customer"], spec, day, B, inc.changed_since_day(day))


@query("staging_purge")
def q_staging_purge(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    return inc.staging_purge(stg["transaction"], src["transaction"], "transaction_id")


@query("staging_upsert")
def q_staging_upsert(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    spec = SPEC_BY_NAME["account"]
    return inc.staging_upsert(stg["account"], src["account"], spec,
                              inc.read_mark(stg["account"]), B)


@query("append_staging")
def q_append_staging(spark, sf_dir):
    src, stg = _src_stg(spark, sf_dir)
    spec = SPEC_BY_NAME["transaction"]
    ext = inc.incremental_extract(src["transaction"], spec, inc.read_mark(stg["transaction"]), B)
    cols = list(spec.columns) + ["dtmload"]
    return stg["transaction"].select(*cols).unionByName(ext.select(*cols))


def _staging_load_query(name):
    def fn(spark, sf_dir):
        src, stg = _src_stg(spark, sf_dir)
        return inc.staging_load(stg, src, [SPEC_BY_NAME[name]], B)[name]
    return fn


for _s in STAGING_TABLES:
    QUERIES[f"staging_load_{_s.name}"] = _staging_load_query(_s.name)


@query("in_list")
def q_in_list(spark, sf_dir):
    src = adapter.source_tables(spark, sf_dir)["customer"]
    return src.where(F.col("customer_id").isin(4, 5, 7, 8)).select(*SPEC_BY_NAME["customer"].columns)


@query("sorted_extract")
def q_sorted_extract(spark, sf_dir):
    return q_incremental_create_only(spark, sf_dir).orderBy("dtmcrt", "account_id")


# --- quality ---------------------------------------------------------------------

@query("pk_violations")
def q_pk_violations(spark, sf_dir):
    return quality.pk_violations(scenario.raw(spark, sf_dir)["transaction"], "transaction_id")


@query("fk_violations")
def q_fk_violations(spark, sf_dir):
    r = scenario.raw(spark, sf_dir)
    t = r["transaction"]
    a = quality.fk_violations(t, "account_id", r["account"], "account_id", "transaction_account")
    b = quality.fk_violations(t, "branch_id", adapter.branches_with_orphans(r["branch"]),
                              "branch_id", "transaction_branch")
    c = quality.fk_violations(r["account"], "customer_id", r["customer"], "customer_id",
                              "account_customer")
    return a.unionByName(b).unionByName(c)


@query("not_null_violations")
def q_not_null_violations(spark, sf_dir):
    core = scenario.first_load(spark, sf_dir)
    cols = list(CORE_NOT_NULL["FactTransaction"])
    return quality.not_null_violations(core.fact, cols, "FactTransaction")


@query("length_violations")
def q_length_violations(spark, sf_dir):
    spec = SPEC_BY_NAME["account"]
    return quality.length_violations(scenario.raw(spark, sf_dir)["account"], spec.varchar,
                                     "account_raw")


def _union(parts):
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


@query("declared_primary_keys")
def q_declared_primary_keys(spark, sf_dir):
    tables = scenario.declared_tables(spark, sf_dir)
    staged = scenario.raw(spark, sf_dir)
    return _union([quality.key_summary(n, tables[n], keys) for n, keys in PRIMARY_KEYS.items()]
                  + [quality.key_summary(s.raw_name, staged[s.name], [s.key]) for s in STAGING_TABLES])


@query("declared_foreign_keys")
def q_declared_foreign_keys(spark, sf_dir):
    tables = scenario.declared_tables(spark, sf_dir)
    return _union(quality.reference_summary(f"{child}_{fk}", tables[child], fk, tables[parent], pk)
                  for child, fk, parent, pk in FOREIGN_KEYS)


@query("declared_not_null")
def q_declared_not_null(spark, sf_dir):
    tables = scenario.declared_tables(spark, sf_dir)
    staged = scenario.raw(spark, sf_dir)
    return _union([quality.not_null_violations(tables[n], cols, n) for n, cols in CORE_NOT_NULL.items()]
                  + [quality.not_null_violations(staged[s.name], s.not_null, s.raw_name) for s in STAGING_TABLES])


@query("declared_lengths")
def q_declared_lengths(spark, sf_dir):
    tables = scenario.declared_tables(spark, sf_dir)
    staged = scenario.raw(spark, sf_dir)
    return _union([quality.length_violations(tables[n], limits, n) for n, limits in VARCHAR_LIMITS.items()]
                  + [quality.length_violations(staged[s.name], s.varchar, s.raw_name) for s in STAGING_TABLES])


@query("rejects")
def q_rejects(spark, sf_dir):
    return scenario.fact_rejects(spark, sf_dir)


# --- banks: conversion, queries, sinks ---------------------------------------------



def _banks(spark, sf_dir):
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return fx.fx_convert(fx.banks_from_suppliers(sup), scenario.rates_csv(spark))


@query("fx_convert")
def q_fx_convert(spark, sf_dir):
    return _banks(spark, sf_dir)


@query("avg_gbp")
def q_avg_gbp(spark, sf_dir):
    return fx.average(_banks(spark, sf_dir), "MC_GBP_Billion", "avg_gbp")


@query("limit5")
def q_limit5(spark, sf_dir):
    return fx.first_by_rank(_banks(spark, sf_dir), 5)


@query("select_all")
def q_select_all(spark, sf_dir):
    return _banks(spark, sf_dir).select("*")


@query("adhoc_sql")
def q_adhoc_sql(spark, sf_dir):
    return spark.sql("SELECT Country, MC_GBP_Billion FROM {banks} WHERE MC_USD_Billion >= :lo",
                     args={"lo": 5000.0}, banks=_banks(spark, sf_dir))


@query("replace_table")
def q_replace_table(spark, sf_dir):
    base = work_path(spark, "tables", "banks_table")
    writers.publish_version(_banks(spark, sf_dir), base)      # first run
    return writers.replace_table(spark, _banks(spark, sf_dir), base)  # replaced


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    path = writers.write_csv(_banks(spark, sf_dir), work_path(spark, "csv", "banks"))
    schema = ("Rank long, Country string, MC_USD_Billion double, MC_EUR_Billion double, "
              "MC_GBP_Billion double, MC_INR_Billion double")
    return spark.read.schema(schema).option("header", True).csv(path)


@query("drop_last_char")
def q_drop_last_char(spark, sf_dir):
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    txt = F.format_string("%.2f", F.col("s_acctbal"))
    return sup.select(F.col("s_suppkey").alias("Rank"), txt.alias("mc_text"),
                      drop_last_char(txt).alias("mc_trimmed"),
                      safe_double(drop_last_char(txt)).alias("MC_USD_Billion"))


@query("safe_numeric")
def q_safe_numeric(spark, sf_dir):
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    rank_txt = F.when(F.col("s_suppkey") % 7 == 0, F.lit("n/a")) \
        .otherwise(F.col("s_suppkey").cast("string"))
    mc_txt = F.when(F.col("s_suppkey") % 11 == 0, F.lit("")) \
        .otherwise(F.format_string("%.2f", F.col("s_acctbal")))
    return sup.select(F.col("s_suppkey").alias("key"), safe_long(rank_txt).alias("Rank"),
                      safe_double(mc_txt).alias("MC_USD_Billion"))


# --- dates and formats -------------------------------------------------------------

@query("parse_mixed_dates")
def q_parse_mixed_dates(spark, sf_dir):
    t = scenario.transaction_texts(spark, sf_dir).select("transaction_id", "date_text")
    return with_mixed_dates(t, "date_text", "parsed")


@query("date_id")
def q_date_id(spark, sf_dir):
    t = adapter.source_tables(spark, sf_dir)["transaction"]
    return t.select("transaction_id", F.date_format("transaction_date", "yyyyMMdd").alias("day_key"),
                    date_id("transaction_date").alias("DateID"))


@query("format_ts")
def q_format_ts(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select("event_id",
                     F.date_format("ts", FORMAT_ISO_SECONDS).alias("f_iso"),
                     F.date_format("ts", FORMAT_SNAPSHOT).alias("f_snapshot"),
                     F.date_format("ts", FORMAT_COMPACT).alias("f_compact"),
                     F.date_format("ts", FORMAT_LOG).alias("f_log"))


# --- bronze bars -------------------------------------------------------------------

# The ticker list of the ingest (one has no data).
TICKERS = ("click", "purchase", "view", "refund")


def _bars(spark, sf_dir):
    return bronze.bars_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("bronze_last5")
def q_bronze_last5(spark, sf_dir):
    return bronze.last_sessions(_bars(spark, sf_dir), 5)


@query("ticker_semi")
def q_ticker_semi(spark, sf_dir):
    bars = bronze.for_tickers(_bars(spark, sf_dir), bronze.tickers_frame(spark, TICKERS))
    return bronze.last_sessions(bars, 5)


@query("bronze_rejects")
def q_bronze_rejects(spark, sf_dir):
    return bronze.missing_tickers(_bars(spark, sf_dir), bronze.tickers_frame(spark, TICKERS))


@query("bronze_partitions")
def q_bronze_partitions(spark, sf_dir):
    path = work_path(spark, "bronze")
    bronze.write_bronze(q_ticker_semi(spark, sf_dir), path, B)
    return bronze.read_bronze(spark, path)


@query("bronze_run")
def q_bronze_run(spark, sf_dir):
    out = work_path(spark, "bronze_run")
    paths = bronze_run.run_bronze(spark, _bars(spark, sf_dir), bronze.tickers_frame(spark, TICKERS),
                                  out, B)
    return bronze.read_bronze(spark, paths["bronze"])


@query("bronze_rerun")
def q_bronze_rerun(spark, sf_dir):
    """The same batch landed twice gives one snapshot."""
    out = work_path(spark, "bronze_rerun")
    for _ in range(2):
        paths = bronze_run.run_bronze(spark, _bars(spark, sf_dir), bronze.tickers_frame(spark, TICKERS), out, B)
    return bronze.read_bronze(spark, paths["bronze"])


@query("bronze_path")
def q_bronze_path(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    last = ev.groupBy(F.col("event_type").alias("Company")).agg(F.max("ts").alias("stamp"))
    return bronze.object_paths(last, "stamp")


# --- files -------------------------------------------------------------------------

def _file_ingest(spark, sf_dir):
    base = scenario.write_transaction_files(spark, sf_dir, work_path(spark, "files"))
    return files.ingest_csv_dir(spark, base, B)


@query("file_ingest_csv")
def q_file_ingest_csv(spark, sf_dir):
    good, _, _ = _file_ingest(spark, sf_dir)
    return good.drop("file_path")


@query("invalid_dates")
def q_invalid_dates(spark, sf_dir):
    _, bad_rows, _ = _file_ingest(spark, sf_dir)
    return bad_rows.select("transaction_id", F.col("__date_text").alias("date_text"),
                           "reject_reason")


@query("file_isolation")
def q_file_isolation(spark, sf_dir):
    _, _, bad_files = _file_ingest(spark, sf_dir)
    return bad_files.groupBy("reject_reason").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").cast("bigint").alias("n_rows"))


def _workbook_ingest(spark, sf_dir):
    base = scenario.write_transaction_workbooks(spark, sf_dir, work_path(spark, "workbooks"))
    return xlsx.ingest_xlsx(spark, [base], B)


@query("file_ingest_xlsx")
def q_file_ingest_xlsx(spark, sf_dir):
    good, _, _ = _workbook_ingest(spark, sf_dir)
    return good.drop("file_path")


@query("xlsx_rejected_files")
def q_xlsx_rejected_files(spark, sf_dir):
    _, bad_rows, bad_files = _workbook_ingest(spark, sf_dir)
    per_file = bad_files.select("reject_reason", F.lit(1).alias("n_files"), F.lit(0).alias("n_bad_rows"))
    per_row = bad_rows.select("reject_reason", F.lit(0).alias("n_files"), F.lit(1).alias("n_bad_rows"))
    return per_file.unionByName(per_row).groupBy("reject_reason").agg(
        F.sum("n_files").cast("bigint").alias("n_files"), F.sum("n_bad_rows").cast("bigint").alias("n_bad_rows"))


@query("union_sources")
def q_union_sources(spark, sf_dir):
    good, _, _ = _file_ingest(spark, sf_dir)
    db = QUERIES["staging_load_transaction"](spark, sf_dir)
    cols = list(SPEC_BY_NAME["transaction"].columns) + ["dtmload"]
    return db.select(*cols).unionByName(good.select(*cols))


@query("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf_dir):
    ext = q_incremental_extract(spark, sf_dir)
    path = writers.write_parquet_parts(ext, work_path(spark, "spool", "transaction"), 10_000)
    return spark.read.parquet(path)


# --- html ---------------------------------------------------------------------------

@query("html_rows")
def q_html_rows(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = html.extract_rows(pages, container=None, row="li", cell=None)
    return html.link_rows(rows)


@query("html_table")
def q_html_table(spark, sf_dir):
    return html.bank_rows(html.extract_rows(scenario.bank_pages(spark, sf_dir)))


@query("banks_pipeline")
def q_banks_pipeline(spark, sf_dir):
    """Pages -> table rows -> conversion with rates from a CSV -> CSV and table."""
    res = banks_run.run_banks(spark, html.banks(scenario.bank_pages(spark, sf_dir)), scenario.rates_csv(spark),
                              work_path(spark, "banks_pipeline"), "banks-run", B)
    return res["table"]


# --- streaming, run log, whole run ----------------------------------------------



def _stream_run(spark, sf_dir):
    base = scenario.write_transaction_files(spark, sf_dir, work_path(spark, "drop"))
    out = work_path(spark, "stream_out")
    stream.run_file_ingest(spark, f"{base}/*/*.csv", out, work_path(spark, "stream_ckpt"), B,
                           max_files_per_trigger=2)
    return out


@query("stream_file_ingest")
def q_stream_file_ingest(spark, sf_dir):
    out = _stream_run(spark, sf_dir)
    return stream.read_staged(spark, out).drop("batch_id")


@query("stream_daily_totals")
def q_stream_daily_totals(spark, sf_dir):
    """Totals per day in which every transaction id counts once, with its latest version, held
    in the state of a second stream over the staged rows."""
    out, totals = _stream_run(spark, sf_dir), work_path(spark, "stream_totals")
    latest_versions.run_daily_totals(spark, f"{out}/staged", totals, work_path(spark, "totals_ckpt"))
    return latest_versions.read_daily_totals(spark, totals)


def _stream_both_kinds(spark, sf_dir):
    """CSV files and workbooks (with a broken one) dropped into the same folders."""
    base = scenario.write_transaction_files(spark, sf_dir, work_path(spark, "drop"), adapter.FILE_ID_OFFSET)
    scenario.write_transaction_workbooks(spark, sf_dir, base)
    out = work_path(spark, "stream_out")
    stream.run_file_ingest(spark, f"{base}/*/*.{{csv,xlsx}}", out, work_path(spark, "stream_ckpt"), B,
                           max_files_per_trigger=4)
    return out


@query("stream_mixed_files")
def q_stream_mixed_files(spark, sf_dir):
    return stream.read_staged(spark, _stream_both_kinds(spark, sf_dir)).drop("batch_id")


@query("stream_mixed_rejects")
def q_stream_mixed_rejects(spark, sf_dir):
    rejected = stream.read_rejected_files(spark, _stream_both_kinds(spark, sf_dir))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_files"),
                                                 F.sum("n_rows").cast("bigint").alias("n_rows"))


@query("stream_rejected_files")
def q_stream_rejected_files(spark, sf_dir):
    rejected = stream.read_rejected_files(spark, _stream_run(spark, sf_dir))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_files"),
                                                 F.sum("n_rows").cast("bigint").alias("n_rows"))


@query("stream_daily_summary")
def q_stream_daily_summary(spark, sf_dir):
    return stream.read_summary(spark, _stream_run(spark, sf_dir))


@query("run_log")
def q_run_log(spark, sf_dir):
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    res = banks_run.run_banks(spark, fx.banks_from_suppliers(sup), scenario.rates_csv(spark),
                              work_path(spark, "banks_run"), "banks-run", B)
    return res["run_log"]


def _warehouse(spark, sf_dir):
    return warehouse_run.run_all(spark, adapter.source_tables(spark, sf_dir),
                                 work_path(spark, "warehouse"), B)


@query("warehouse_run")
def q_warehouse_run(spark, sf_dir):
    return spark.read.parquet(_warehouse(spark, sf_dir)["CustomerMart"])


@query("warehouse_run_daily")
def q_warehouse_run_daily(spark, sf_dir):
    return spark.read.parquet(_warehouse(spark, sf_dir)["DailySummaryMart"])


@query("warehouse_run_log")
def q_warehouse_run_log(spark, sf_dir):
    base = work_path(spark, "warehouse")
    warehouse_run.run_all(spark, adapter.source_tables(spark, sf_dir), base, B)
    return warehouse_run.read_run_log(spark, base)


@query("warehouse_run_files")
def q_warehouse_run_files(spark, sf_dir):
    """The customer mart of a run that also takes transaction files (ids of their own)."""
    folder = scenario.write_transaction_files(spark, sf_dir, work_path(spark, "daily_files"),
                                              adapter.FILE_ID_OFFSET)
    paths = warehouse_run.run_all(spark, adapter.source_tables(spark, sf_dir), work_path(spark, "warehouse"), B,
                                  files_dir=folder)
    return spark.read.parquet(paths["CustomerMart"])


@query("warehouse_second_run")
def q_warehouse_second_run(spark, sf_dir):
    """Staged transactions after a second run: late updates purge and re-extract rows, and the
    rows of one month all move to other months, so that month is empty."""
    base = work_path(spark, "warehouse")
    first, second = adapter.two_runs(spark, sf_dir)
    warehouse_run.run_all(spark, first, base, adapter.PREV_RUN_END)
    warehouse_run.run_all(spark, second, base, B)
    return warehouse_run.read_staged_transactions(spark, base)


def _two_runs(spark, sf_dir):
    base = work_path(spark, "warehouse")
    first, second = adapter.two_runs(spark, sf_dir)
    warehouse_run.run_all(spark, first, base, adapter.PREV_RUN_END)
    return warehouse_run.run_all(spark, second, base, B)


@query("mart_incremental")
def q_mart_incremental(spark, sf_dir):
    """The customer mart that a second run brought up to date from the fact's changed months."""
    return spark.read.parquet(_two_runs(spark, sf_dir)["CustomerMart"])


@query("mart_incremental_daily")
def q_mart_incremental_daily(spark, sf_dir):
    """The daily summary that a second run brought up to date from the fact's changed months."""
    return spark.read.parquet(_two_runs(spark, sf_dir)["DailySummaryMart"])


class _Stopped(Exception):
    pass


@query("warehouse_recovered_run")
def q_warehouse_recovered_run(spark, sf_dir):
    """Staged transactions after a second run, with files, that stopped when it had written its
    fact and was started again."""
    base = work_path(spark, "warehouse")
    folder = scenario.write_transaction_files(spark, sf_dir, work_path(spark, "daily_files"), adapter.FILE_ID_OFFSET)
    first, second = adapter.two_runs(spark, sf_dir)
    warehouse_run.run_all(spark, first, base, adapter.PREV_RUN_END)

    def stop(name: str) -> None:
        if name == "FactTransaction":
            raise _Stopped

    try:
        warehouse_run.run_all(spark, second, base, B, files_dir=folder, on_write=stop)
    except _Stopped:
        pass
    warehouse_run.run_all(spark, second, base, B, files_dir=folder)
    return warehouse_run.read_staged_transactions(spark, base)


@query("namespaces")
def q_namespaces(spark, sf_dir):
    """One table of each layer registered in its namespace, counted through the catalog. The
    namespaces are new ones, so no table of the session's catalog is touched."""
    from ledgerline.sinks.writers import ensure_namespaces, register_table

    own = {n: f"{n}_{uuid.uuid4().hex[:8]}" for n in ("staging", "core", "mart")}
    layers = ensure_namespaces(spark, tuple(own.values()))
    core = scenario.first_load(spark, sf_dir)
    tables = {"staging.branch_raw": scenario.raw(spark, sf_dir)["branch"], "core.dimbranch": core.dim_branch,
              "mart.dailysummarymart": marts.daily_summary(core.fact, core.dim_date)}
    out = None
    for name, df in tables.items():
        namespace, table = name.split(".")
        t = register_table(df, f"{own[namespace]}.{table}", work_path(spark, "namespaces"))
        c = t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(namespace).alias("namespace"), F.lit(table).alias("table_name"),
            F.lit(own[namespace] in layers).alias("listed"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out
