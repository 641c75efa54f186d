"""Properties of the whole run: idempotence and sum identities."""

from __future__ import annotations

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.functions.money import signed_amount
from ledgerline.plans import adapter, scenario
from ledgerline.plans.warehouse_run import read_fact, read_staged_transactions, run_all
from ledgerline.session import local_path, work_path


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_second_run_changes_nothing(spark):
    base = work_path(spark, "prop_wh")
    src = adapter.source_tables(spark, SF_SMALL)
    # batch times after every source timestamp (updates in the data reach 2004)
    first = run_all(spark, src, base, "2010-01-01 00:00:00")
    staged_first = _rows(read_staged_transactions(spark, base))
    second = run_all(spark, src, base, "2010-01-02 00:00:00")
    for t in ("CustomerMart", "DailySummaryMart"):
        a, b = spark.read.parquet(first[t]), spark.read.parquet(second[t])
        assert _rows(a) == _rows(b), t
    assert _rows(read_staged_transactions(spark, base)) == staged_first
    assert not [d for d in os.listdir(local_path(second["transaction_raw"]))
                if d.startswith("__part=")]
    # nothing changed after the first run's marks, so no row was updated again
    # nothing was inserted or updated, so the second run wrote no fact month
    assert not [d for d in os.listdir(local_path(second["FactTransaction"]))
                if d.startswith("__part=")]
    shape = scenario.first_load(spark, SF_SMALL).fact
    fact = read_fact(spark, base, shape)
    assert _rows(fact) == _rows(spark.read.parquet(first["FactTransaction"]).drop("__part"))


def test_mart_sums_match_fact(spark):
    core = scenario.first_load(spark, SF_SMALL)
    from ledgerline.operators import marts
    daily = marts.daily_summary(core.fact, core.dim_date)
    f = core.fact.agg(F.sum("Amount").alias("s"), F.count(F.lit(1)).alias("n")).first()
    d = daily.agg(F.sum("TotalTransactionAmount").alias("s"),
                  F.sum("TotalTransactions").alias("n")).first()
    assert (d.s, d.n) == (f.s, f.n)
    cm = marts.customer_mart(core.dim_customer, core.dim_account, core.fact)
    delta = cm.agg(F.sum(F.col("CurrentBalance") - F.col("BaseBalance")).alias("x")).first().x
    signed = core.fact.join(core.dim_account.select("AccountID", "CustomerID"), "AccountID") \
        .join(core.dim_customer.select("CustomerID"), "CustomerID") \
        .agg(F.sum(signed_amount("TransactionType", "Amount")).alias("x")).first().x
    assert delta == signed


def test_update_rewrites_only_its_month(spark):
    base = work_path(spark, "prop_wh_upd")
    src = adapter.source_tables(spark, SF_SMALL)
    run_all(spark, src, base, "2010-01-01 00:00:00")
    one = src["transaction"].orderBy("transaction_id").first()
    changed = dict(src)
    changed["transaction"] = src["transaction"].withColumn(
        "amount", F.when(F.col("transaction_id") == one.transaction_id, F.lit(1.5))
                   .otherwise(F.col("amount"))).withColumn(
        "dtmupd", F.when(F.col("transaction_id") == one.transaction_id,
                         F.lit("2010-01-01 12:00:00").cast("timestamp_ntz"))
                   .otherwise(F.col("dtmupd")))
    second = run_all(spark, changed, base, "2010-01-02 00:00:00")
    parts = [d for d in os.listdir(local_path(second["FactTransaction"])) if d.startswith("__part=")]
    assert parts == [f"__part={one.transaction_date.year * 100 + one.transaction_date.month}"]
    shape = scenario.first_load(spark, SF_SMALL).fact
    row = read_fact(spark, base, shape).where(F.col("TransactionID") == one.transaction_id).first()
    assert float(row.Amount) == 1.5 and row.dtmupd.isoformat() == "2010-01-02T00:00:00"


def test_run_writes_rejects_and_log(spark):
    from ledgerline.plans.warehouse_run import read_run_log
    base = work_path(spark, "prop_wh_log")
    written = run_all(spark, adapter.source_tables(spark, SF_SMALL), base, "2010-01-01 00:00:00")
    log = {r.stage: r.rows for r in read_run_log(spark, base).collect()}
    assert log["transaction_raw"] == spark.read.parquet(written["transaction_raw"]).count()
    assert log["CustomerMart"] == spark.read.parquet(written["CustomerMart"]).count()
    assert log["rejects_transaction"] == 0 and log["rejects_customer"] == 0
    assert len(log) == len(written)


def test_files_are_taken_once_by_the_run(spark, tmp_dir):
    drop = os.path.join(tmp_dir, "in")
    os.makedirs(drop)
    head = "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id\n"
    src = adapter.source_tables(spark, SF_SMALL)
    one = src["transaction"].orderBy("transaction_id").first()
    row = lambda i: f"{i},{one.account_id},03-01-1997,10,Deposit,{one.branch_id}\n"
    for name, text in (("a.csv", head + row(10 ** 12)), ("bad.csv", "transaction_id\n1\n")):
        with open(os.path.join(drop, name), "w") as f:
            f.write(text)
    base = work_path(spark, "wh_files")
    first = run_all(spark, src, base, "2010-01-01 00:00:00", files_dir=drop)
    assert spark.read.parquet(first["rejects_files"]).count() == 1
    with open(os.path.join(drop, "b.csv"), "w") as f:
        f.write(head + row(10 ** 12 + 1))
    second = run_all(spark, src, base, "2010-01-02 00:00:00", files_dir=drop)
    assert spark.read.parquet(second["files_taken"]).count() == 3
    third = run_all(spark, src, base, "2010-01-03 00:00:00", files_dir=drop)
    assert "files_taken" not in third   # nothing new
    shape = scenario.first_load(spark, SF_SMALL).fact
    ids = [r.TransactionID for r in read_fact(spark, base, shape).where("TransactionID >= 1000000000000").collect()]
    assert sorted(ids) == [10 ** 12, 10 ** 12 + 1]
