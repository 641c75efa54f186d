"""Hand-written fixtures for the semantics that bite."""

from __future__ import annotations

import datetime as dt
import os
import zipfile
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions.money import signed_amount
from ledgerline.operators import bronze, incremental, merge, quality
from ledgerline.operators.joins import anti_new_keys
from ledgerline.schemas import TableSpec
from ledgerline.sources import files, html
from ledgerline.sources.files import ingest_csv_dir
from ledgerline.sources.xlsx import ingest_xlsx, workbook_rows


def T(s):
    return dt.datetime.fromisoformat(s)


# --- NOT IN with nulls -----------------------------------------------------------

def test_anti_join_matches_not_in(spark):
    rows = spark.createDataFrame([(1,), (None,), (3,)], "id long")
    target = spark.createDataFrame([(1,)], "id long")
    empty = spark.createDataFrame([], "id long")
    assert sorted(r.id for r in anti_new_keys(rows, target, "id").collect()) == [3]
    # on an empty target NOT IN keeps the null key; it belongs to rejects here
    assert sorted(r.id for r in anti_new_keys(rows, empty, "id").collect()) == [1, 3]


# --- collation ------------------------------------------------------------------

def test_deposit_compared_case_insensitively(spark):
    df = spark.createDataFrame(
        [("Deposit", Decimal("10.00")), ("DEPOSIT", Decimal("10.00")),
         ("deposit ", Decimal("10.00")), ("Transfer", Decimal("10.00")),
         (None, Decimal("10.00")), ("Deposit", None)],
        "type string, amount decimal(18,2)")
    got = [r.s for r in df.select(signed_amount("type", "amount").alias("s")).collect()]
    assert got == [Decimal("10.00")] * 3 + [Decimal("-10.00")] * 2 + [Decimal("0.00")]


# --- high-water marks, purge and upsert --------------------------------------------

SPEC = TableSpec("t", "t_id", ("t_id", "v", "dtmcrt"))


def _staging_pair(spark):
    staged = spark.createDataFrame([
        (1, "a", T("2024-01-01 00:00:00"), T("2024-01-02 10:00:00")),  # updated after load
        (2, "b", T("2024-01-01 00:00:00"), T("2024-01-02 10:00:00")),  # updated before load
        (4, "d", T("2024-01-01 00:00:00"), T("2024-01-02 10:00:00")),  # never updated
        (7, "g", T("2024-01-02 09:59:59"), T("2024-01-02 10:00:00.500")),  # last second
    ], "t_id long, v string, dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    src = spark.createDataFrame([
        (1, "a2", T("2024-01-01 00:00:00"), T("2024-01-03 00:00:00")),
        (2, "b", T("2024-01-01 00:00:00"), T("2024-01-02 09:00:00")),
        (3, "c", T("2024-01-03 00:00:00"), None),                       # new
        (4, "d", T("2024-01-01 00:00:00"), None),
        (5, "e", None, None),                                           # never read
        (6, "f", T("2024-01-02 10:00:00"), None),                       # equal to mark
        (7, "g", T("2024-01-02 10:00:00.300"), None),                   # inside last second
    ], "t_id long, v string, dtmcrt timestamp_ntz, dtmupd timestamp_ntz")
    return staged, src


def test_mark_is_cut_to_seconds_with_default(spark):
    staged, _ = _staging_pair(spark)
    assert incremental.read_mark(staged) == "2024-01-02 10:00:00"
    assert incremental.read_mark(staged.limit(0)) == "1900-01-01 00:00:00"


def test_extract_purge_upsert(spark):
    staged, src = _staging_pair(spark)
    mark = incremental.read_mark(staged)
    ext = incremental.incremental_extract(src, SPEC, mark, "2024-01-04 00:00:00")
    assert sorted(r.t_id for r in ext.collect()) == [1, 3, 7]
    kept = incremental.staging_purge(staged, src, "t_id")
    assert sorted(r.t_id for r in kept.collect()) == [2, 4, 7]
    up = incremental.staging_upsert(staged, src, SPEC, mark, "2024-01-04 00:00:00")
    assert sorted((r.t_id, r.v) for r in up.collect()) == [
        (1, "a2"), (2, "b"), (3, "c"), (4, "d"), (7, "g"), (7, "g")]


def test_upsert_twice_is_idempotent_per_key(spark):
    staged, src = _staging_pair(spark)
    b = "2024-01-04 00:00:00"
    once = incremental.staging_upsert(staged, src, SPEC, incremental.read_mark(staged), b)
    once = spark.createDataFrame(once.collect(), once.schema)  # six-row fixture
    twice = incremental.staging_upsert(once, src, SPEC, incremental.read_mark(once), b)
    assert sorted(r.t_id for r in twice.collect()) == sorted(r.t_id for r in once.collect())


# --- type-1 merge ----------------------------------------------------------------

def test_merge_latest_change_wins_and_null_is_written(spark):
    target = spark.createDataFrame([
        (1, "old1", T("2024-01-01 00:00:00"), None),
        (2, "old2", T("2024-01-01 00:00:00"), None),
    ], "id long, v string, dtmload timestamp_ntz, dtmupd timestamp_ntz")
    changes = spark.createDataFrame([
        (1, "new1a", T("2024-01-02 00:00:00"), T("2024-01-01 00:00:00")),
        (1, "new1b", T("2024-01-03 00:00:00"), T("2024-01-01 00:00:00")),
        (2, None, T("2024-01-02 00:00:00"), T("2024-01-01 00:00:00")),
        (9, "absent", T("2024-01-02 00:00:00"), T("2024-01-01 00:00:00")),
    ], "id long, v string, dtmload timestamp_ntz, dtmcrt timestamp_ntz")
    ch = merge.changes_after(changes, "id", "2024-01-01 00:00:00")
    out = merge.merge_type1(target, "id", ch, "id", {"v": F.col("v")}, "2024-01-05 00:00:00")
    got = {r.id: (r.v, r.dtmupd) for r in out.collect()}
    assert got == {1: ("new1b", T("2024-01-05 00:00:00")), 2: (None, T("2024-01-05 00:00:00"))}


# --- quality ---------------------------------------------------------------------

def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "toolongvalue"), (None, None)],
                               "k long, s string")
    pk = {(r.k, r.n_rows) for r in quality.pk_violations(df, "k").collect()}
    assert pk == {(1, 2), (None, 1)}
    nn = {r.column_name: r.n_null for r in quality.not_null_violations(df, ["k", "s"], "t").collect()}
    assert nn == {"k": 1, "s": 1}
    ln = quality.length_violations(df, {"s": 5}, "t").first()
    assert (ln.n_too_long, ln.max_length) == (1, 12)
    parent = spark.createDataFrame([(1,)], "p long")
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c long")
    fk = [(r.key_value, r.n_rows) for r in quality.fk_violations(child, "c", parent, "p", "x").collect()]
    assert fk == [(2, 2)]


# --- HTML ------------------------------------------------------------------------

BANK_PAGE = """<html><body><table><tbody>
<tr><th>Rank</th><th>Bank</th><th>Cap</th></tr>
<tr><td>1</td><td><a href="/f">flag</a> <a href="/j">JPMorgan Chase</a></td><td>432.92
</td></tr>
<tr><td>2</td><td>No link here</td><td>231.5
</td></tr>
<tr><td>x</td><td><a href="/b">Bank &amp; Co</a></td><td>194.57
</td></tr>
</tbody></table>
<table><tbody><tr><td>9</td><td><a>Other table</a></td><td>1.0
</td></tr></tbody></table></body></html>"""


def test_bank_table_rows(spark):
    pages = spark.createDataFrame([(1, "u", BANK_PAGE)], "page_id long, url string, html string")
    rows = html.bank_rows(html.extract_rows(pages))
    got = [(r.Rank, r.Country, r.MC_USD_Billion) for r in rows.orderBy("row_no").collect()]
    # header row (th only), the row without a link and the second table are skipped;
    # the figure loses its last character after stripping
    assert got == [(1, "JPMorgan Chase", 432.9), (None, "Bank & Co", 194.5)]


# --- bronze --------------------------------------------------------------------------

def test_last_sessions_and_missing_tickers(spark):
    ticks = []
    for c in ("AAA", "BBB"):
        for d in range(1, 8):
            for k, v in enumerate((10.0, 12.0, 9.0, 11.0)):
                ticks.append((c, T(f"2024-01-0{d} 10:00:0{k}"), v, k))
    df = spark.createDataFrame(ticks, "c string, ts timestamp_ntz, v double, id long")
    bars = bronze.daily_bars(df, "c", "ts", "v", "id")
    last = bronze.last_sessions(bars, 5)
    assert last.count() == 10
    r = last.where("Company = 'AAA' AND Date = DATE '2024-01-07'").first()
    assert (r.Open, r.High, r.Low, r.Close, r.Volume) == (10.0, 12.0, 9.0, 11.0, 4)
    tick = bronze.tickers_frame(spark, ["AAA", "CCC"])
    assert [x.Company for x in bronze.missing_tickers(bars, tick).collect()] == ["CCC"]


# --- files ---------------------------------------------------------------------------

HEADER = "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id"


def _write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def test_file_isolation(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "good.csv"),
           HEADER + "\r\n1,10,21-01-2024 14:00:00,100,Deposit,4\r\n2,11,x,5,Payment,1")
    _write(os.path.join(tmp_dir, "nobranch.csv"),
           "transaction_id,account_id,transaction_date,amount,transaction_type\n"
           "3,12,21-01-2024,7,Deposit\n")
    _write(os.path.join(tmp_dir, "onlybad.csv"), HEADER + "\n4,13,31-02-2024,1,Deposit,1\n")
    _write(os.path.join(tmp_dir, "extra.csv"),
           "branch_id,note,transaction_id,account_id,transaction_date,amount,transaction_type\n"
           "9,hello,5,14,2024-02-01,3,Withdrawal\n")
    good, bad_rows, bad_files = ingest_csv_dir(spark, tmp_dir, "2024-03-01 00:00:00")
    assert sorted((r.transaction_id, r.branch_id) for r in good.collect()) == [(1, 4), (5, 9)]
    assert sorted(r.transaction_id for r in bad_rows.collect()) == [2, 4]
    bf = bad_files.collect()
    assert len(bf) == 1 and bf[0].file_path.endswith("nobranch.csv")
    assert bf[0].reject_reason == "missing columns: branch_id" and bf[0].n_rows == 1


def _xlsx(path, rows):
    def cell(ref, v):
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return f'<c r="{ref}"><v>{v}</v></c>'
    body = "".join(
        f'<row r="{i}">' + "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(r)) + "</row>"
        for i, r in enumerate(rows, start=1))
    sheet = ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.'
             'openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + body +
             "</sheetData></worksheet>")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)


def test_xlsx_ingest(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.xlsx")
    _xlsx(p, [HEADER.split(","), [1, 10, "21-01-2024 14:00:00", 100, "Deposit", 4],
              [2, 11, "bad", 5, "Payment", 1]])
    assert list(workbook_rows(open(p, "rb").read()))[1][0] == "1"
    good, bad_rows, bad_files = ingest_xlsx(spark, [tmp_dir], "2024-03-01 00:00:00")
    assert [(r.transaction_id, r.amount) for r in good.collect()] == [(1, 100.0)]
    assert bad_rows.count() == 1 and bad_files.count() == 0


def test_bad_workbooks_do_not_stop_the_others(spark, tmp_dir):
    rows = [HEADER.split(","), [1, 10, "21-01-2024", 100, "Deposit", 4]]
    _xlsx(os.path.join(tmp_dir, "a.xlsx"), rows)
    _xlsx(os.path.join(tmp_dir, "empty.xlsx"), [])
    _xlsx(os.path.join(tmp_dir, "missing.xlsx"), [["transaction_id"], [5]])
    _write(os.path.join(tmp_dir, "broken.xlsx"), "no workbook")
    whole = open(os.path.join(tmp_dir, "a.xlsx"), "rb").read()
    sheet = zipfile.ZipFile(os.path.join(tmp_dir, "a.xlsx")).read("xl/worksheets/sheet1.xml")
    with zipfile.ZipFile(os.path.join(tmp_dir, "torn.xlsx"), "w") as z:   # breaks off after its rows
        z.writestr("xl/worksheets/sheet1.xml", sheet[:-20])
    assert whole
    wide = [[f"c{i}" for i in range(20)] + HEADER.split(","), ["v"] * 20 + [2, 11, "22-01-2024", 7, "Payment", 1]]
    _xlsx(os.path.join(tmp_dir, "wide.xlsx"), wide)
    good, bad_rows, bad_files = ingest_xlsx(spark, [tmp_dir], "2024-03-01 00:00:00")
    assert sorted((r.transaction_id, r.branch_id) for r in good.collect()) == [(1, 4), (2, 1)]
    assert bad_rows.count() == 0
    got = {os.path.basename(r.file_path): (r.reject_reason, r.n_rows) for r in bad_files.collect()}
    assert got == {"broken.xlsx": ("unreadable workbook: BadZipFile", 0),
                   "torn.xlsx": ("unreadable workbook: ParseError", 0), "empty.xlsx": ("no header line", 0),
                   "missing.xlsx": ("missing columns: account_id, transaction_date, amount, transaction_type, "
                                    "branch_id", 1)}


def test_wide_and_quoted_files(spark, tmp_dir):
    extra = ",".join(f"x{i}" for i in range(60))
    _write(os.path.join(tmp_dir, "wide.csv"), f"{extra},{HEADER}\n" + ",".join("v" * 60)
           + ',1,10,21-01-2024,100,"Dep ""x"", y",4\n')
    _write(os.path.join(tmp_dir, "quoted_header.csv"), '\ufeff"transaction_id","account_id",transaction_date,'
           'amount,transaction_type,"branch_id"\n2,11,22-01-2024,5,"a, b",7\n')
    _write(os.path.join(tmp_dir, "blank.csv"), "\n\n")
    _write(os.path.join(tmp_dir, "only_header.csv"), HEADER + "\n")
    good, bad_rows, bad_files = ingest_csv_dir(spark, tmp_dir, "2024-03-01 00:00:00")
    got = {r.transaction_id: (r.transaction_type, r.branch_id) for r in good.collect()}
    assert got == {1: ('Dep "x", y', 4), 2: ("a, b", 7)}
    assert bad_rows.count() == 0
    assert [(os.path.basename(r.file_path), r.reject_reason) for r in bad_files.collect()] == [
        ("blank.csv", "no header line")]


def test_blank_header_cells_keep_their_place(spark, tmp_dir):
    """A saved data frame with its index, and a gap in the middle of the header."""
    _write(os.path.join(tmp_dir, "index.csv"), f",{HEADER}\n0,1,10,21-01-2024,100,Deposit,4\n1,2,11,22-01-2024,5,x,7\n")
    _write(os.path.join(tmp_dir, "gap.csv"), "transaction_id,account_id,transaction_date,,amount,transaction_type,branch_id,\n"
           "11,22,2024-01-15,999,500,Deposit,3,\n12,22,2024-01-15,,7,,3\n")
    _write(os.path.join(tmp_dir, "quoted.csv"), f'"","  ",{HEADER}\na,b,3,12,23-01-2024,8,Payment,9\n')
    good, bad_rows, bad_files = ingest_csv_dir(spark, tmp_dir, "2024-03-01 00:00:00")
    got = {r.transaction_id: (r.account_id, r.amount, r.transaction_type, r.branch_id) for r in good.collect()}
    assert got == {1: (10, 100.0, "Deposit", 4), 2: (11, 5.0, "x", 7), 11: (22, 500.0, "Deposit", 3),
                   12: (22, 7.0, None, 3), 3: (12, 8.0, "Payment", 9)}
    assert bad_rows.count() == 0 and bad_files.count() == 0


def test_file_names_are_taken_literally(spark, tmp_dir):
    names = ["my file.csv", "a+b.csv", "100%.csv", "per%20cent.csv", "day [1].csv", "{x}.csv", "star*.csv", "q?.csv", "plain.csv"]
    for i, name in enumerate(names):
        _write(os.path.join(tmp_dir, name), f"{HEADER}\n{i},10,21-01-2024,100,Deposit,4\n")
    listed = {r.path: r.file_path for r in files.list_files(spark, [tmp_dir]).collect()}
    assert sorted(os.path.basename(p) for p in listed) == sorted(names)
    for i, name in enumerate(names):   # each file alone, by its own name
        path = next(p for p in listed if p.endswith("/" + name))
        good, _, rejected = files.ingest_csv(spark, [files.literal_path(path)], "2024-03-01 00:00:00")
        assert [(r.transaction_id, r.file_path) for r in good.collect()] == [(i, listed[path])], name
        assert rejected.count() == 0


def test_collation_ignores_case_and_trailing_blanks(spark):
    from ledgerline.functions.money import signed_amount
    from ledgerline.functions.text import collated

    rows = [(1, "Deposit", 5), (2, "DEPOSIT  ", 5), (3, "deposit ", 5), (4, " deposit", 5), (5, None, 5), (6, "Payment", 5)]
    df = spark.createDataFrame(rows, "k int, t string, a int").withColumn("a", F.col("a").cast("decimal(18,2)"))
    got = {r.k: float(r.s) for r in df.select("k", signed_amount("t", "a").alias("s")).collect()}
    assert got == {1: 5, 2: 5, 3: 5, 4: -5, 5: -5, 6: -5}
    assert sorted(r["count"] for r in df.groupBy(collated("t").alias("t")).count().collect()) == [1, 1, 1, 3]
    assert {r.t for r in df.where(collated("t") == "deposit").collect()} == {"Deposit", "DEPOSIT  ", "deposit "}   # kept as written


def test_quoted_line_breaks_with_multi_line(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "m.csv"), HEADER + '\n1,10,21-01-2024,100,"two\nlines",4\n2,11,22-01-2024,5,x,7\n')
    good, bad_rows, _ = ingest_csv_dir(spark, tmp_dir, "2024-03-01 00:00:00", multi_line=True)
    assert {r.transaction_id: r.transaction_type for r in good.collect()} == {1: "two\nlines", 2: "x"}
    assert bad_rows.count() == 0


def test_update_keeps_rows_whose_city_is_missing(spark):
    target = spark.createDataFrame(
        [(1, "A", "X", "OLD", "S", 30, "M", "e", T("2024-01-01 00:00:00"), None)],
        "CustomerID long, CustomerName string, Address string, CityName string, StateName string, Age int, "
        "Gender string, Email string, dtmload timestamp_ntz, dtmupd timestamp_ntz")
    cust = spark.createDataFrame(
        [(1, "new", "y", 99, 31, "f", "e2", T("2024-01-01 00:00:00"), T("2024-02-02 00:00:00"))],
        "customer_id long, customer_name string, address string, city_id long, age int, gender string, "
        "email string, dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    lookup = "dtmcrt timestamp_ntz, dtmload timestamp_ntz"
    city = spark.createDataFrame([], f"city_id long, city_name string, state_id long, {lookup}")
    state = spark.createDataFrame([], f"state_id long, state_name string, {lookup}")
    out = merge.update_dim_customer(target, cust, city, state, "2024-03-01 00:00:00")
    assert out.collect() == target.collect()


def test_same_batch_lands_one_snapshot(spark, tmp_dir):
    from ledgerline.plans.bronze_run import run_bronze
    rows = [("AAA", T(f"2024-01-0{d} 10:00:00"), float(d), d) for d in range(1, 8)]
    ticks = spark.createDataFrame(rows, "c string, ts timestamp_ntz, v double, id long")
    bars = bronze.daily_bars(ticks, "c", "ts", "v", "id")
    for _ in range(2):
        run_bronze(spark, bars, bronze.tickers_frame(spark, ["AAA", "ZZZ"]), tmp_dir, "2024-01-08 06:00:00")
    assert bronze.read_bronze(spark, os.path.join(tmp_dir, "bronze")).count() == 5
    assert spark.read.parquet(os.path.join(tmp_dir, "rejects")).count() == 1


def test_customer_rejects_missing_city(spark):
    from ledgerline.operators.dimensions import customer_rejects, dim_customer
    cust = spark.createDataFrame([
        (1, "a", "x", 10, 30, "m", "e", T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00")),
        (2, "b", "y", 99, 30, "f", "e", T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00")),
        (None, "c", "z", 10, 30, "f", "e", T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00")),
    ], "customer_id long, customer_name string, address string, city_id long, age int, "
       "gender string, email string, dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    city = spark.createDataFrame([(10, "c10", 1, T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00"))],
                                 "city_id long, city_name string, state_id long, "
                                 "dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    state = spark.createDataFrame([(1, "s1", T("2024-01-01 00:00:00"), T("2024-01-02 00:00:00"))],
                                  "state_id long, state_name string, dtmcrt timestamp_ntz, "
                                  "dtmload timestamp_ntz")
    assert [r.CustomerID for r in dim_customer(cust, city, state, "2024-02-01 00:00:00").collect()] == [1]
    rej = sorted((r.CustomerID or 0, r.reject_reason)
                 for r in customer_rejects(cust, city, state).collect())
    assert rej == [(0, "null_key"), (2, "no_city")]


def test_bronze_run_snapshots_and_log(spark, tmp_dir):
    from ledgerline.plans.bronze_run import run_bronze
    from ledgerline.sinks import writers
    rows = [(c, T(f"2024-01-0{d} 10:00:00"), float(d), d) for c in ("AAA", "BBB") for d in range(1, 8)]
    ticks = spark.createDataFrame(rows, "c string, ts timestamp_ntz, v double, id long")
    bars = bronze.daily_bars(ticks, "c", "ts", "v", "id")
    tick = bronze.tickers_frame(spark, ["AAA", "ZZZ"])
    out = os.path.join(tmp_dir, "b")
    run_bronze(spark, bars, tick, out, "2024-01-08 06:00:00")
    run_bronze(spark, bars, tick, out, "2024-01-09 06:00:00")   # second daily run
    snap = bronze.read_bronze(spark, os.path.join(out, "bronze"))
    assert snap.count() == 10 and {r.Company for r in snap.collect()} == {"AAA"}
    assert bronze.latest_snapshot_per_day(snap).count() == 5
    rej = spark.read.parquet(os.path.join(out, "rejects")).collect()
    assert {r.Company for r in rej} == {"ZZZ"} and len(rej) == 2
    log = writers.read_run_log(spark, os.path.join(out, "run_log"))
    assert [r.rows for r in log.where("stage = 'ingestion_end'").collect()] == [5, 5]
