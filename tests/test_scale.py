"""Steps that must stay cheap on large input."""

from __future__ import annotations

import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from ledgerline.functions import dates
from ledgerline.sinks.run_state import State
from ledgerline.sinks.xlsx import workbook, write_workbooks
from ledgerline.sources import files, xlsx
from ledgerline.streaming.latest_versions import LatestVersion


def test_common_forms_are_read_without_tokens_and_alike(spark):
    texts = ["21-01-2024 14:00:00", "1995-02-30", "2024-13-05", "05-13-2024", "2024/01/21 10:00:01.250", "20240121",
             "20240121103059", "20240121T1030", "21-Jan-2024", "January 5, 2024", "2024-Jan-05", "3/4/70", "3/4/68",
             "5 Jan 2024", "Fri, 05 Jan 2024", "Friday 5 January 2024", "05-March-1995 12:30 PM", "31-02-1995",
             "2024-01-21T10:00:00.123Z", "2024-01-21T10:00:00+05:30"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", dates._form(dates._plain(F.col("s"))).alias("form"), dates.parse_mixed_dates("s").alias("d"),
                    dates._bind(dates.date_tokens("s"), dates._from_tokens).alias("by_tokens")).collect()
    assert [r.s for r in got if r.form is None] == []
    assert [(r.s, r.d) for r in got] == [(r.s, r.by_tokens) for r in got]
    assert {r.s: r.d for r in got}["2024-01-21T10:00:00+05:30"] == dt.datetime(2024, 1, 21, 4, 30)


def test_a_table_no_run_has_written_moves_no_rows(spark, tmp_dir):
    state = State(spark, os.path.join(tmp_dir, "none"))
    for empty in (state.read("a", "k long"), state.read_parts("a", "k long")):
        plan = spark.range(10).join(empty, F.col("id") == F.col("k"), "left_anti")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


def test_rows_of_a_sheet_are_complete_across_chunks():
    rows = [["a", "b"], *[[str(i), f"x & {i}" if i % 3 else None] for i in range(9000)]]
    assert [r + [None] * (2 - len(r)) for r in xlsx.workbook_rows(workbook(iter(rows)))] == rows


def test_files_are_parsed_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in", "a.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as f:
        f.write("transaction_id,account_id,transaction_date,amount,transaction_type,branch_id\n"
                "1,10,21-01-2024,5,Deposit,4\n2,10,bad,5,Deposit,4\n")
    good, bad, _ = files.ingest_csv(spark, [path], "2024-02-01 00:00:00")
    os.remove(path)   # both are read from the rows that were typed once
    assert [r.transaction_id for r in good.collect()] == [1]
    assert [r.transaction_id for r in bad.collect()] == [2]


def test_a_block_of_ids_is_one_call_to_the_state():
    class Held:
        def __init__(self):
            self.value, self.calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

    p, day = LatestVersion(), dt.datetime(2024, 1, 5)
    p.counted = held = Held()
    rows = [Row(transaction_id=i, transaction_date=day, amount=float(i), branch_id=1, transaction_type="a", block=0) for i in range(50)]
    assert len(list(p.handleInputRows((0,), iter(rows), None))) == 50
    later = Row(transaction_id=3, transaction_date=day + dt.timedelta(1), amount=1.0, branch_id=1, transaction_type="a", block=0)
    changes = list(p.handleInputRows((0,), iter([later, rows[4]]), None))
    assert [(c.n, c.amount) for c in changes] == [(-1, 3.0), (1, 1.0)]
    assert held.calls == 4 and len(held.value[0]) == 50


def test_orphan_accounts_replace_the_shuffle_by_account(spark):
    from ledgerline.operators.facts import fact_rejects, fact_transaction, orphan_accounts

    day = dt.datetime(2024, 1, 5)
    cols = ("transaction_id long, account_id long, transaction_date timestamp_ntz, amount double, transaction_type string, "
            "branch_id long, dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    t = spark.createDataFrame([(1, 10, day, 1.0, "a", 1, day, day), (2, 11, day, 1.0, "a", 1, day, day), (3, None, day, 1.0, "a", 1, day, day),
                               (None, 10, day, 1.0, "a", 1, day, day), (4, 10, day, 1.0, "a", 2, day, day), (4, 10, day, 2.0, "b", 1, day, day),
                               (2, 11, day, 1.0, "a", 1, day, day)], cols)
    account, branch = spark.createDataFrame([(10,)], "AccountID long"), spark.createDataFrame([(1,)], "BranchID long")
    dim_date = spark.createDataFrame([(day.date(), 20240105)], "FullDate date, DateID int")
    orphans = orphan_accounts(t, account)
    assert [r[0] for r in orphans.collect()] == [11]
    for make in (lambda **o: fact_transaction(t, account, branch, dim_date, "2024-02-01 00:00:00", **o),
                 lambda **o: fact_rejects(t, account, branch, dim_date, **o)):
        plain, stored = (sorted(map(str, make(**o).collect())) for o in ({}, {"orphans": orphans}))
        assert plain == stored and plain


def test_a_first_load_writes_the_fact_once(spark, tmp_dir, monkeypatch):
    from conftest import SF_SMALL
    from ledgerline.plans import adapter, warehouse_run as W

    asked, real = [], W.work_path
    monkeypatch.setattr(W, "work_path", lambda s, *parts: asked.append(parts[0]) or real(s, *parts))
    sources = adapter.source_tables(spark, SF_SMALL)
    for stamp in ("2010-01-01 00:00:00", "2010-01-02 00:00:00"):
        W.run_all(spark, sources, os.path.join(tmp_dir, "dwh"), stamp)
    assert asked == ["orphan-accounts", "orphan-accounts", "new-facts"]


def test_texts_put_in_order_agree_with_the_forms(spark):
    times = {"dmy": ("", " 7:05", " 23:59:59", " 24:00"), "ymd": ("", " 07:05", " 10:11:12.5", "T10:11", "T10:11:12.123Z"), "packed": ("", "101112", "T1011")}
    texts = [f"{d}{x}{m}{x}{y}{t}" for d in ("5", "05", "13", "31") for m in ("2", "02", "13", "Feb", "february") for y in ("2024", "99")
             for x in "-/. " for t in times["dmy"]]
    texts += [f"1999{x}{m}{x}{d}{t}" for m in ("2", "13", "feb") for d in ("5", "30") for x in "-/ " for t in times["ymd"]]
    texts += [f"{d}{t}" for d in ("20240229", "20230229", "20241301", "20240431") for t in times["packed"]]
    texts += ["Feb 5, 2024", "February 5 2024 7:05", "Foo 5, 2024", "05-\x012-2024"]
    s = F.col("s")

    def by_form(c):
        return dates._bind(dates._plain(c), lambda s: dates._bind(dates._form(s), lambda form: F.when(
            form.isNotNull(), dates._from_form(s, form)).otherwise(dates._bind(dates.date_tokens(c), dates._from_tokens))))

    df = spark.createDataFrame([(t,) for t in texts], "s string").repartition(4)
    got = df.select("s", dates.parse_mixed_dates(s).alias("d"), by_form(s).alias("by_form")).collect()
    assert [r for r in got if r.d != r.by_form and not r.s.startswith("05-\x01")] == [] and sum(r.d is not None for r in got) > 100
    # a common text is read without a pattern: it has no other reading than its order
    usual = spark.createDataFrame([("21-01-2024 14:00:00",), ("January 5, 2024",), ("20240121T1030",), ("2024-01-21T10:00:00.123Z",)], "s string")
    alone = usual.select(dates._bind(s, lambda t: dates._in_order(t, F.lit(None).cast("timestamp_ntz"))).alias("d")).collect()
    assert [r.d for r in alone] == [dt.datetime(2024, 1, 21, 14), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 21, 10, 30),
                                    dt.datetime(2024, 1, 21, 10, 0, 0, 123000)]


def test_a_file_is_written_from_packed_rows(spark, tmp_dir):
    from conftest import SF_SMALL
    from ledgerline.plans import scenario

    t = scenario.transaction_texts(spark, SF_SMALL)
    rows = scenario._dealt(t, os.path.join(tmp_dir, "rows"))
    assert {k: len(v) for k, v in rows.items()} == {"good": 6, "frame": 4, "bad": 1}
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() and df.rdd.getNumPartitions() == 1
               for some in rows.values() for df in some)
    assert sum(df.count() for k in ("good", "frame") for df in rows[k]) == t.where("account_id is not null").count()
    assert rows["bad"][0].count() == t.where("transaction_id % 10 = 1").count()


def test_a_plain_sheet_is_cut_by_its_tags_alone(monkeypatch):
    """No tree and no expression a cell for inline texts, whatever signs are in them; the same rows as from the tree."""
    rows = [[f"a{i}", None if i % 5 else "", f"x & <{i}> \"ü€\"", "&amp;", " "] for i in range(4000)]
    content = workbook(iter(rows))
    with zipfile.ZipFile(io.BytesIO(content)) as z, z.open("xl/worksheets/sheet1.xml") as sheet:
        assert list(xlsx._sheet_rows(sheet, [], set())) == rows
    for other in ("_sheet_rows", "_cells", "_plain_cells"):
        monkeypatch.setattr(xlsx, other, None)
    assert list(xlsx.workbook_rows(content)) == rows


def test_other_sheets_are_cut_as_their_tree_says():
    main = xlsx._NS["m"]
    cells = ['<c r="B1" t="s"><v>1</v></c>', '<c s="1"><v>45000.5</v></c>', '<c r="D1"><v>3.0</v></c>', '<c t="str"><f>A1</f><v>x</v></c>',
             '<c><f t="shared" si="0">A1</f><v>7</v></c>', "<c><v/></c>", '<c t="inlineStr"/>', '<c t="n"><is><t>x</t></is></c>',
             '<c t="inlineStr"><is><t>a&#10;b</t></is></c>', '<c t="inlineStr"><is><r><t>ri</t></r><r><t>ch</t></r></is></c>',
             '<c t="inlineStr"><is><t>l\r\nm</t></is></c>', '<c t="inlineStr"><is><t>a&amp;b</t></is></c>', '<c t="b"><v>1</v></c>', "<c/>",
             '<c t="inlineStr"><is><t><![CDATA[<row>]]></t></is></c>', '<c t="s"><v>9</v></c>', '<c s="1"><v>x</v></c>',
             '<c t="inlineStr"><is><t>&no;</t></is></c>', '<c t="inlineStr"><is><t>\x01</t></is></c>', "<c><v>1</c>", '<c t="n" t="n"><v>1</v></c>']

    def outcome(rows):
        out = []
        try:
            for row in rows:
                out.append(row)
        except Exception as e:
            return type(e).__name__
        return out

    for cell in cells:
        for start in ("<row>", '<row r="1" spans="1:3" x:d="0.25">', '<row r="1"/>\n<row>'):
            sheet = (f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{main}" xmlns:x="urn:x"><sheetData><row><c/></row>{start}'
                     f"{cell}<c t=\"inlineStr\"><is><t>z</t></is></c></row></sheetData><pageMargins/></worksheet>").encode()
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w") as z:
                z.writestr("xl/worksheets/sheet1.xml", sheet)
                z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>s0</t></si><si><t>s1</t></si></sst>')
                z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
            assert outcome(xlsx.workbook_rows(packed.getvalue())) == outcome(xlsx._sheet_rows(io.BytesIO(sheet), ["s0", "s1"], {1})), cell


def test_workbooks_are_written_by_columns(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a & <b>", None), (None, "", "ü")], "x string, y string, z string").coalesce(1)
    done = write_workbooks(df, os.path.join(tmp_dir, "books"), max_rows=1).collect()
    assert [r["rows"] for r in done] == [1, 1]
    got = [list(xlsx.workbook_rows(open(r["path"], "rb").read())) for r in done]
    assert got == [[["x", "y", "z"], ["1", "a & <b>", None]], [["x", "y", "z"], [None, "", "ü"]]]


def test_offsets_and_halves_of_the_day_are_read_in_order(spark):
    times = ("1:05", "01:05", "12:00", "12:59", "11:60", "13:00", "0:30")
    texts = [f"{d}{x}{m}{x}{y} {t} {h}" for d in ("5", "31") for m in ("Feb", "march", "December") for y in ("2024", "0999") for x in "- "
             for t in times for h in ("AM", "pm")]
    texts += [f"2024-{m}-{d}T{t}{z}" for m in ("2", "12", "13") for d in ("1", "29", "31") for t in ("0:00:00", "23:59:59", "24:00:00", "7:60:00")
              for z in ("+05:30", "-00:00", "-11:45", "+17:59", "+18:00", "+05:60")]
    s = F.col("s")
    df = spark.createDataFrame([(t,) for t in texts], "s string").repartition(4)

    def by_form(c):
        return dates._bind(dates._plain(c), lambda s: dates._bind(dates._form(s), lambda form: F.when(
            form.isNotNull(), dates._from_form(s, form)).otherwise(dates._bind(dates.date_tokens(c), dates._from_tokens))))

    got = df.select("s", dates.parse_mixed_dates(s).alias("d"), by_form(s).alias("by_form")).collect()
    assert [r for r in got if r.d != r.by_form] == [] and sum(r.d is not None for r in got) > 100
    usual = spark.createDataFrame([("05-March-1995 12:30 AM",), ("5 Mar 1995 1:05 pm",), ("1995-03-05T01:00:00+05:30",)], "s string")
    alone = usual.select(dates._bind(s, lambda t: dates._in_order(t, F.lit(None).cast("timestamp_ntz"))).alias("d")).collect()
    assert [r.d for r in alone] == [dt.datetime(1995, 3, 5, 0, 30), dt.datetime(1995, 3, 5, 13, 5), dt.datetime(1995, 3, 4, 19, 30)]


def _typed_files(spark, folder):
    """Files of several layouts, wide and ragged ones among them, and what is read of them."""
    head = "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id"
    wide = ",".join(f"x{i}" for i in range(30))
    texts = {"a": f"{head}\n1,10,21-01-2024,5,Deposit,4\n2,10,21-01-2024,5\n3,10,21-01-2024,5,Deposit,4,more,and more\n\n",
             "b": f"branch_id,{wide},{head.rsplit(',', 1)[0]}\n7,{wide},4,11,22-01-2024,6,\"a, \"\"b\"\"\"\n8,{wide},5\n",
             "c": "transaction_id,amount\n9,1\n9,2\n", "d": "\n \n"}
    os.makedirs(folder)
    for name, text in texts.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)
    return folder


def test_only_required_columns_are_cut_out_of_the_lines(spark, tmp_dir, monkeypatch):
    scans, real = [], files.pick
    monkeypatch.setattr(files, "pick", lambda data, required: scans.append(data) or real(data, required))
    good, bad, rejected = files.ingest_csv(spark, [_typed_files(spark, os.path.join(tmp_dir, "in"))], "2024-02-01 00:00:00")
    cols = ("transaction_id", "account_id", "amount", "transaction_type", "branch_id")
    assert sorted(tuple(r[c] for c in cols) for r in good.collect()) == [
        (1, 10, 5.0, "Deposit", 4), (2, 10, 5.0, None, None), (3, 10, 5.0, "Deposit", 4), (4, 11, 6.0, 'a, "b"', 7)]
    assert [(r.transaction_id, r.branch_id) for r in bad.collect()] == [(5, 8)]
    assert sorted((os.path.basename(r.file_path), r.n_rows) for r in rejected.collect()) == [("c.csv", 2), ("d.csv", 0)]
    plan = scans[0]._jdf.queryExecution().executedPlan().toString()
    assert "_c5:string" in plan and "_c31:string" in plan and "_c7:string" not in plan
    only_bad = os.path.join(tmp_dir, "bad")
    os.makedirs(only_bad)
    with open(os.path.join(only_bad, "e.csv"), "w") as f:
        f.write("x,y\n1,2\n")
    good, bad, rejected = files.ingest_csv(spark, [only_bad], "2024-02-01 00:00:00")
    assert (good.count(), bad.count(), [r.n_rows for r in rejected.collect()]) == (0, 0, [1])


def test_rows_of_files_are_stored_once_and_packed_rows_not_kept(spark, tmp_dir, monkeypatch):
    from conftest import SF_SMALL
    from ledgerline.plans import adapter, scenario, warehouse_run as W

    asked, real = [], scenario.work_path
    monkeypatch.setattr(scenario, "work_path", lambda s, *parts: asked.append((parts[0], real(s, *parts))) or asked[-1][1])
    monkeypatch.setattr(W, "work_path", lambda s, *parts: asked.append((parts[0], real(s, *parts))) or asked[-1][1])
    folder = scenario.write_transaction_files(spark, SF_SMALL, os.path.join(tmp_dir, "in"), adapter.FILE_ID_OFFSET)
    assert not os.path.exists(dict(asked)["file-rows"])
    asked.clear()
    run = W.Run(spark, os.path.join(tmp_dir, "dwh"), "20100101_000000")
    rows = W._take_files(run, folder, "2010-01-01 00:00:00")
    assert [what for what, _ in asked] == ["new-files", "typed-rows", "file-files"]
    assert rows.count() + run.counts["rejects_file_rows"] == spark.read.parquet(dict(asked)["typed-rows"]).count()
    assert run.counts["rejects_files"] == 1 and run.counts["files_taken"] == 11


def test_a_state_of_the_smaller_blocks_is_refused(spark, tmp_dir):
    from ledgerline.streaming import latest_versions as L

    assert len({i >> L.BLOCK_BITS for i in range(1000)}) == 1   # entries of the state that an epoch reads and writes
    staged, out, state = (os.path.join(tmp_dir, x) for x in ("staged", "totals", "state"))
    day = dt.datetime(2024, 1, 5)
    rows = spark.createDataFrame([(i, 1, day, 1.0, "a", 1, day, day) for i in range(1, 400)],
                                 "transaction_id long, account_id long, transaction_date timestamp_ntz, amount double, "
                                 "transaction_type string, branch_id long, dtmcrt timestamp_ntz, dtmload timestamp_ntz")
    rows.write.parquet(f"{staged}/batch_id=a")
    spark.conf.set(L.PROVIDER, L.ROCKSDB)
    try:   # the stream as it was
        old = (spark.readStream.schema(L.STAGED_SCHEMA).parquet(staged)
               .select("transaction_id", "transaction_date", "amount", "branch_id", "transaction_type",
                       F.shiftright("transaction_id", 6).alias("block"))
               .groupBy("block").transformWithState(L.LatestVersion(), L.CHANGE, "Append", "None"))
        old.writeStream.outputMode("append").foreachBatch(lambda batch, epoch: batch.collect()).option(
            "checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(L.PROVIDER)
    rows.write.parquet(f"{staged}/batch_id=b")
    with pytest.raises(Exception, match="KEY_SCHEMA_NOT_COMPATIBLE"):
        L.run_daily_totals(spark, staged, out, state)
    L.run_daily_totals(spark, staged, out, f"{state}-new")
    assert [tuple(r) for r in L.read_daily_totals(spark, out).collect()] == [(day.date(), 399, 399)]
