"""One commit point per run, and marts kept by signed changes."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.operators import marts
from ledgerline.plans import adapter, scenario
from ledgerline.plans import warehouse_run as W
from ledgerline.session import work_path
from ledgerline.sinks.run_state import PARTITION, Run, State

HEADER = "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id\n"


class Stopped(Exception):
    pass


def small_sources(spark, sf_dir=SF_SMALL):
    """Two runs' sources, written once with few rows, so that many runs stay cheap."""
    base = work_path(spark, "recovery_sources")
    out = []
    for i, tables in enumerate(adapter.two_runs(spark, sf_dir)):
        few = dict(tables)
        few["account"] = few["account"].where("account_id <= 40")
        few["transaction"] = few["transaction"].where("account_id <= 40")
        for n, df in few.items():
            df.coalesce(1).write.parquet(f"{base}/{i}/{n}")
        out.append({n: spark.read.parquet(f"{base}/{i}/{n}") for n in few})
    return out


def contents(spark, base):
    """All rows of all tables, without the names of the directories."""
    state, out = State(spark, base), {}
    for kind, name, part in sorted(state.entries):
        value = state.entries[kind, name, part]
        if kind == "mark":
            out[name] = value
        elif name not in ("staging/files_taken", "rejects/files"):
            rows = spark.read.parquet(value)
            drop = [c for c in ("file_path",) if c in rows.columns]
            out[name, part] = sorted(map(str, rows.drop(*drop).collect()))
        else:
            out[name, part] = spark.read.parquet(value).count()
    return out


def drop_folder(tmp_dir, source):
    folder = os.path.join(tmp_dir, "new files")
    os.makedirs(folder)
    one = source["transaction"].first()
    for i in range(2):
        with open(os.path.join(folder, f"day {i}.csv"), "w") as f:
            f.write(HEADER + f"{10 ** 12 + i},{one.account_id},03-01-1997,10,Deposit,{one.branch_id}\n")
    return folder


def test_a_run_stopped_after_any_write_is_started_again(spark, tmp_dir):
    first, second = small_sources(spark)
    folder = drop_folder(tmp_dir, second)
    whole, broken = work_path(spark, "wh_whole"), work_path(spark, "wh_broken")
    for base in (whole, broken):
        W.run_all(spark, first, base, adapter.PREV_RUN_END)
    before = State(spark, broken).entries
    names: list[str] = []
    W.run_all(spark, second, whole, adapter.BATCH_TS, files_dir=folder, on_write=names.append)
    assert len(names) > 18

    # the state, all that a restart starts from, is untouched after every single write
    for stop_at in ("files_taken", "FactTransaction", "run_log"):
        assert stop_at in names

        def stop(name, stop_at=stop_at):
            assert State(spark, broken).entries == before, name
            if name == stop_at:
                raise Stopped(name)

        with pytest.raises(Stopped):
            W.run_all(spark, second, broken, adapter.BATCH_TS, files_dir=folder, on_write=stop)
        assert State(spark, broken).entries == before
    W.run_all(spark, second, broken, adapter.BATCH_TS, files_dir=folder)
    assert contents(spark, broken) == contents(spark, whole)
    ids = {r.transaction_id for r in W.read_staged_transactions(spark, broken).where("transaction_id >= 1000000000000").collect()}
    assert ids == {10 ** 12, 10 ** 12 + 1}


def test_second_run_reads_only_changed_months_for_the_marts(spark):
    sources = adapter.source_tables(spark, SF_SMALL)
    base = work_path(spark, "wh_delta")
    W.run_all(spark, sources, base, "2010-01-01 00:00:00")
    one = sources["transaction"].orderBy("transaction_id").first()
    hit = F.col("transaction_id") == one.transaction_id
    changed = dict(sources)
    changed["transaction"] = sources["transaction"].withColumn("amount", F.when(hit, F.lit(1.5)).otherwise(F.col("amount"))).withColumn(
        "dtmupd", F.when(hit, F.lit("2010-01-01 12:00:00").cast("timestamp_ntz")).otherwise(F.col("dtmupd")))
    before = State(spark, base)
    W.run_all(spark, changed, base, "2010-01-02 00:00:00")
    after = State(spark, base)
    months = [p for p, leaf in after.parts(W.FACT).items() if before.parts(W.FACT).get(p) != leaf]
    assert months == [str(one.transaction_date.year * 100 + one.transaction_date.month)]
    # the same change as the run took it: files of that month alone, as it was and as it is
    run = Run(spark, base, "x")
    run.entries, run.now = before.entries, after
    schema = scenario.first_load(spark, SF_SMALL).fact.schema
    change = W.changed_fact_rows(run, schema, months)
    read = {os.path.dirname(f).removeprefix("file://").removeprefix("file:") for f in change.inputFiles()}
    assert read == {s.entries[PARTITION, W.FACT, months[0]].removeprefix("file:") for s in (before, after)}
    # and the marts equal a full rebuild
    fact = W.read_fact(spark, base, scenario.first_load(spark, SF_SMALL).fact)
    dim = {n: W.read_table(spark, base, f"core/{n}") for n in ("DimCustomer", "DimAccount", "DimDate")}
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(W.read_table(spark, base, "mart/CustomerMart")) == rows(marts.customer_mart(dim["DimCustomer"], dim["DimAccount"], fact))
    assert rows(W.read_table(spark, base, "mart/DailySummaryMart")) == rows(marts.daily_summary(fact, dim["DimDate"]))


def test_signed_changes(spark):
    """Inserts, changed amounts and types, moves between accounts and days, deletions, nulls."""
    schema = "AccountID long, TransactionDateID int, TransactionType string, Amount decimal(18,2)"
    from decimal import Decimal as D
    old = [(1, 20240101, "DEPOSIT", D("5.00")), (1, 20240102, "PAYMENT", D("2.00")), (2, 20240101, None, None), (3, 20240103, "DEPOSIT", D("9.00"))]
    new = [(1, 20240101, "PAYMENT", D("5.00")), (4, 20240102, "PAYMENT", D("2.50")), (2, 20240101, None, None), (2, 20240104, "Deposit ", D("1.00"))]
    before, after = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    change = before.withColumn("__sign", F.lit(-1)).unionByName(after.withColumn("__sign", F.lit(1)))
    rows = lambda df: sorted(map(tuple, df.collect()))
    days = marts.add_day_changes(marts.day_total(before), change)
    assert rows(days) == rows(marts.day_total(after))
    nets = {r.AccountID: r.Net for r in marts.add_account_changes(marts.account_net(before), change).collect()}
    assert {k: v for k, v in nets.items() if v} == {r.AccountID: r.Net for r in marts.account_net(after).collect() if r.Net}


def test_range_reads_only_its_months(spark):
    from test_plans import plan

    base = work_path(spark, "wh_pruned")
    W.run_all(spark, adapter.source_tables(spark, SF_SMALL), base, "2010-01-01 00:00:00")
    fact = W.read_fact_by_month(spark, base, scenario.first_load(spark, SF_SMALL).fact)
    df = marts.daily_range_of_fact(fact, W.read_table(spark, base, "core/DimDate"), "19970101", "19970331")
    assert "dynamicpruningexpression" in plan(df)
    assert df.count() > 0
    scans = [s for s in plan(df, "formatted").splitlines() if "PartitionFilters" in s]
    assert any("__part" in s for s in scans)
    metrics = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in metrics
    direct = fact.where("__part between 199701 and 199703")
    assert "PartitionFilters: [isnotnull(__part" in plan(direct)
    assert {f.split("__part=")[1][:6] for f in direct.inputFiles()} >= {"199701", "199703"}
