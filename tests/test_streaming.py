"""File-drop stream: each file is taken once across runs; parameterised reads."""

from __future__ import annotations

import os

from conftest import SF_SMALL

from ledgerline.operators import marts
from ledgerline.plans import scenario
from ledgerline.session import work_path
from ledgerline.streaming import file_ingest as stream
from ledgerline.streaming import latest_versions

HEADER = "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id\n"


def _drop(d, name, rows):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(HEADER + "".join(rows))


def test_each_file_taken_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drop", "in")
    out, ckpt = work_path(spark, "s_out"), work_path(spark, "s_ckpt")
    _drop(src, "a.csv", ["1,10,21-01-2024 14:00:00,100,Deposit,4\n",
                         "2,11,22-01-2024 09:00:00,50,Payment,1\n"])
    stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.csv", out, ckpt, "2024-02-01 00:00:00")
    _drop(src, "b.csv", ["3,12,22-01-2024 10:00:00,25,Deposit,2\n", "4,13,bad,1,Deposit,2\n"])
    stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.csv", out, ckpt, "2024-02-02 00:00:00")
    staged = stream.read_staged(spark, out)
    assert sorted(r.transaction_id for r in staged.collect()) == [1, 2, 3]
    summary = {r.TransactionDate.isoformat(): (r.TotalTransactions, float(r.TotalTransactionAmount))
               for r in stream.read_summary(spark, out).collect()}
    assert summary == {"2024-01-21": (1, 100.0), "2024-01-22": (2, 75.0)}
    assert [r.transaction_id for r in stream.read_rejects(spark, out).collect()] == [4]


def test_rejected_files_are_recorded_and_new_checkpoint_keeps_old_rows(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "drop", "in"), work_path(spark, "s_out")
    _drop(src, "a.csv", ["1,10,21-01-2024 14:00:00,100,Deposit,4\n"])
    with open(os.path.join(src, "bad.csv"), "w") as f:
        f.write("transaction_id,amount\n7,1\n")
    stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.csv", out, work_path(spark, "s_ckpt"), "2024-02-01 00:00:00")
    rej = stream.read_rejected_files(spark, out).collect()
    assert [(os.path.basename(r.file_path), r.n_rows) for r in rej] == [("bad.csv", 1)]
    # another stream (its own checkpoint) into the same output replaces nothing
    other = os.path.join(tmp_dir, "other", "in")
    _drop(other, "b.csv", ["2,10,22-01-2024,50,Deposit,4\n"])
    stream.run_file_ingest(spark, f"{tmp_dir}/other/*/*.csv", out, work_path(spark, "s_ckpt"), "2024-02-02 00:00:00")
    assert sorted(r.transaction_id for r in stream.read_staged(spark, out).collect()) == [1, 2]


def test_an_epoch_reads_its_own_rows_and_the_total_before(spark, tmp_dir):
    src, out, ckpt = os.path.join(tmp_dir, "drop", "in"), work_path(spark, "s_out"), work_path(spark, "s_ckpt")
    for day in range(1, 6):
        _drop(src, f"{day}.csv", [f"{day},10,0{day}-01-2024,{day},Deposit,4\n", f"{day + 10},10,01-01-2024,1,Deposit,4\n"])
        stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.csv", out, ckpt, "2024-02-01 00:00:00")
    got = {r.TransactionDate.day: (r.TotalTransactions, float(r.TotalTransactionAmount)) for r in stream.read_summary(spark, out).collect()}
    assert got == {1: (6, 6.0), **{d: (1, float(d)) for d in range(2, 6)}}
    # totals of old epochs are gone; running the last epoch again changes nothing
    epochs = [p for paths in stream._epochs(spark, f"{out}/daily_summary").values() for p in paths]
    assert len(epochs) == 2
    for staged in stream.read_staged(spark, out).where("transaction_id = 5").select("batch_id").collect():
        own = spark.read.schema(stream.ROWS).parquet(f"{out}/staged/batch_id={staged.batch_id}")
        stream.add_to_totals(stream.summarize_days(own), f"{out}/daily_summary", staged.batch_id.rsplit("-", 1)[0], staged.batch_id)
    assert {r.TransactionDate.day: r.TotalTransactions for r in stream.read_summary(spark, out).collect()} == {
        1: 6, 2: 1, 3: 1, 4: 1, 5: 1}


def test_workbooks_beside_csv_files(spark, tmp_dir):
    from test_semantics import _xlsx

    src, out = os.path.join(tmp_dir, "drop", "my in"), work_path(spark, "s_out")
    _drop(src, "a b.csv", ["1,10,21-01-2024 14:00:00,100,Deposit,4\n"])
    _xlsx(os.path.join(src, "book [1].xlsx"), [HEADER.strip().split(","), [2, 11, "22-01-2024", 7, "Payment", 1]])
    with open(os.path.join(src, "broken.xlsx"), "w") as f:
        f.write("no workbook")
    stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.{{csv,xlsx}}", out, work_path(spark, "s_ckpt"), "2024-02-01 00:00:00")
    assert sorted(r.transaction_id for r in stream.read_staged(spark, out).collect()) == [1, 2]
    assert [(os.path.basename(r.file_path), r.reject_reason) for r in stream.read_rejected_files(spark, out).collect()] == [
        ("broken.xlsx", "unreadable workbook: BadZipFile")]


def test_repeated_ids_count_once_with_their_latest_version(spark, tmp_dir):
    src, out, ckpt = os.path.join(tmp_dir, "drop", "in"), work_path(spark, "s_out"), work_path(spark, "s_ckpt")
    totals, state = work_path(spark, "totals"), work_path(spark, "totals_ckpt")
    days = {}
    batches = [["1,10,05-01-2024,100,Deposit,4\n", "2,10,05-01-2024,10,Deposit,4\n", ",1,05-01-2024,1,x,1\n"],
               ["1,10,04-01-2024,7,Deposit,4\n", "2,10,06-01-2024,30,Deposit,4\n"],     # an older one, a newer one
               ["2,10,06-01-2024,30,Deposit,4\n", "2,10,06-01-2024,40,Deposit,9\n", "3,10,07-01-2024,,Payment,1\n"]]
    for i, rows in enumerate(batches):
        _drop(src, f"{i}.csv", rows)
        stream.run_file_ingest(spark, f"{tmp_dir}/drop/*/*.csv", out, ckpt, "2024-02-01 00:00:00")
        latest_versions.run_daily_totals(spark, f"{out}/staged", totals, state)   # each call goes on from the checkpoint
        days[i] = {r.TransactionDate.day: (r.TotalTransactions, float(r.TotalTransactionAmount))
                   for r in latest_versions.read_daily_totals(spark, totals).collect()}
    assert days == {0: {5: (2, 110.0)}, 1: {5: (1, 100.0), 6: (1, 30.0)}, 2: {5: (1, 100.0), 6: (1, 40.0), 7: (1, 0.0)}}
    # all at once, from a new checkpoint: the same
    again = work_path(spark, "totals")
    latest_versions.run_daily_totals(spark, f"{out}/staged", again, work_path(spark, "totals_ckpt"))
    rows = lambda p: sorted(map(tuple, latest_versions.read_daily_totals(spark, p).collect()))
    assert rows(again) == rows(totals)


def test_order_of_versions():
    import datetime as dt
    d = dt.datetime
    versions = [(d(2024, 1, 2), 1.0, None, None), (d(2024, 1, 1), 9.0, 1, "a"), (d(2024, 1, 1), 8.0, None, "z"),
                (d(2024, 1, 1), 8.0, 1, None), (d(2024, 1, 1), 8.0, 1, "a"), (d(2024, 1, 1), 8.0, 2, "a"), (d(2024, 1, 1), None, 0, None)]
    for i, a in enumerate(versions):
        assert [latest_versions.before(a, b) for b in versions] == [j > i for j in range(len(versions))]


def test_parameterised_reads_match(spark):
    core = scenario.first_load(spark, SF_SMALL)
    mart = marts.customer_mart(core.dim_customer, core.dim_account, core.fact)
    a = marts.balance_per_customer(mart, "customer#000000007").collect()
    name = marts.create_balance_per_customer(mart)
    b = spark.sql(f"SELECT * FROM {name}('CUSTOMER#000000007 ')").collect()
    assert sorted(a) == sorted(b) and len(a) > 0
    daily = marts.daily_summary(core.fact, core.dim_date)
    x = marts.daily_summary_range(daily, "19970101", "19970131").collect()
    name = marts.create_daily_summary_range(daily)
    y = spark.sql(f"SELECT * FROM {name}('19970101', '19970131')").collect()
    assert sorted(x) == sorted(y) and len(x) > 0


def test_cli_ingest_files(spark, tmp_dir, capsys):
    import json

    from ledgerline import cli
    src = os.path.join(tmp_dir, "drop", "in")
    _drop(src, "a.csv", ["1,10,21-01-2024 14:00:00,100,Deposit,4\n"])
    out = os.path.join(tmp_dir, "out")
    assert cli.main(["ingest-files", "--glob", f"{tmp_dir}/drop/*/*.csv", "--out", out,
                     "--checkpoint", os.path.join(tmp_dir, "ckpt"),
                     "--batch-ts", "2024-02-01 00:00:00"]) == 0
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert paths["staged"].endswith("/staged")
    assert [r.transaction_id for r in stream.read_staged(spark, out).collect()] == [1]
