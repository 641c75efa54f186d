"""Writers, rate files, defaults, namespaces and versioned tables."""

from __future__ import annotations

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ledgerline.functions.dates import ntz
from ledgerline.operators import fx, quality
from ledgerline.sinks import run_state, writers


def test_rate_file_last_row_wins(spark, tmp_dir):
    p = os.path.join(tmp_dir, "rates.csv")
    with open(p, "w") as f:
        f.write("Currency,Rate\nEUR,0.5\nGBP,0.8\nINR,82.95\nEUR,0.93\n")
    lookup = fx.rate_lookup(fx.read_rates(spark, p))
    assert lookup == {"EUR": 0.93, "GBP": 0.8, "INR": 82.95}


def test_column_default(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1))],
                               "id long, dtmload timestamp_ntz")
    out = quality.with_default(df, "dtmload", ntz("2024-02-02 00:00:00"))
    assert [r.dtmload.day for r in out.orderBy("id").collect()] == [2, 1]


def test_parquet_parts_bounded(spark, tmp_dir):
    path = os.path.join(tmp_dir, "spool")
    writers.write_parquet_parts(spark.range(25_000).coalesce(1), path, 10_000)
    assert len(glob.glob(os.path.join(path, "part-*.parquet"))) == 3
    assert spark.read.parquet(path).count() == 25_000


def test_run_log_line_format(spark, tmp_dir):
    path = os.path.join(tmp_dir, "log")
    seen, rows = writers.counted(spark.range(10))
    seen.write.parquet(os.path.join(tmp_dir, "ten"))
    writers.append_run_log(spark, path, "r1", 1, "start", "2026-01-14 15:22:30", "hello")
    writers.append_run_log(spark, path, "r1", 2, "extract", "2026-01-14 15:22:31", "done", rows.get["rows"])
    log = writers.read_run_log(spark, path).withColumn("line", writers.log_line())
    got = [(r.seq, r.rows, r.line) for r in log.orderBy("seq").collect()]
    assert got == [(1, None, "2026-Jan-14-15:22:30 : hello"),
                   (2, 10, "2026-Jan-14-15:22:31 : done")]


def test_namespaces(spark):
    names = writers.ensure_namespaces(spark)
    assert {"staging", "core", "mart"} <= set(names)


def _run(spark, base, rows, stamp="20240101_000000", commit=True):
    run = run_state.Run(spark, base, stamp)
    run.write("t", spark.range(rows).withColumnRenamed("id", "k"))
    if commit:
        run.commit()
    return run


def test_state_is_the_latest_committed_run(spark, tmp_dir):
    count = lambda: run_state.State(spark, tmp_dir).read("t", "k long").count()
    assert count() == 0
    _run(spark, tmp_dir, 3)
    assert count() == 3
    stopped = _run(spark, tmp_dir, 9, "20240102_000000", commit=False)
    assert count() == 3 and stopped.now.read("t", "k long").count() == 9 and stopped.counts == {"t": 9}
    _run(spark, tmp_dir, 5, "20240102_000000")
    assert count() == 5


def test_rerun_of_same_batch_supersedes(spark, tmp_dir):
    for n in (3, 4, 2):   # three runs with the same batch stamp
        _run(spark, tmp_dir, n)
    assert run_state.State(spark, tmp_dir).read("t", "k long").count() == 2


def test_unfinished_manifest_is_passed_over(spark, tmp_dir):
    _run(spark, tmp_dir, 3)
    os.makedirs(os.path.join(tmp_dir, "runs", "v_000000000002"))   # stopped while committing
    assert run_state.State(spark, tmp_dir).read("t", "k long").count() == 3
    _run(spark, tmp_dir, 4)
    assert run_state.State(spark, tmp_dir).read("t", "k long").count() == 4


def test_second_run_at_the_same_time_fails(spark, tmp_dir, monkeypatch):
    import pytest
    from pyspark.errors import AnalysisException

    a, b = (run_state.Run(spark, tmp_dir, "20240101_000000") for _ in range(2))
    for run in (a, b):
        run.write("t", spark.range(2).withColumnRenamed("id", "k"))
    monkeypatch.setattr(run_state, "_manifests", lambda *_: [])   # both looked before either committed
    a.commit()
    with pytest.raises(AnalysisException):
        b.commit()


def test_cli_warehouse_and_banks(spark, tmp_dir, capsys):
    import json as _json

    from conftest import SF_SMALL

    from ledgerline import cli
    from ledgerline.plans import adapter
    src_dir = os.path.join(tmp_dir, "src")
    for name, df in adapter.source_tables(spark, SF_SMALL).items():
        df.write.parquet(os.path.join(src_dir, name))
    assert cli.main(["warehouse", "--sources", src_dir, "--base", os.path.join(tmp_dir, "wh"),
                     "--batch-ts", "2010-01-01 00:00:00"]) == 0
    out = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert spark.read.parquet(out["CustomerMart"]).count() > 0
    banks = os.path.join(tmp_dir, "banks")
    spark.createDataFrame([(1, "A", 100.0), (2, "B", 50.0)],
                          "Rank long, Country string, MC_USD_Billion double").write.parquet(banks)
    rates = os.path.join(tmp_dir, "rates.csv")
    with open(rates, "w") as fh:
        fh.write("Currency,Rate\nEUR,0.93\nGBP,0.8\nINR,82.95\n")
    assert cli.main(["banks", "--banks", banks, "--rates", rates, "--out",
                     os.path.join(tmp_dir, "bo"), "--batch-ts", "2026-01-14 15:22:30"]) == 0
    log = writers.read_run_log(spark, os.path.join(tmp_dir, "bo", "run_log"))
    assert log.count() == 6


def test_later_reader_finds_the_current_version(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    assert writers.current_version(spark, base) is None
    for n in (4, 7):
        assert writers.replace_table(spark, spark.range(n), base).count() == n
    os.makedirs(os.path.join(base, "v_99999999999999999999_dead"))   # never committed
    assert spark.read.parquet(writers.current_version(spark, base)).count() == 7


def test_state_forgets_an_emptied_month(spark, tmp_dir):
    rows = spark.createDataFrame([(1, 202401), (2, 202402)], "k long, m int")
    moved = spark.createDataFrame([(1, 202402), (2, 202402)], "k long, m int")
    for stamp, df in (("20240301_000000", rows), ("20240302_000000", moved)):
        run = run_state.Run(spark, tmp_dir, stamp)
        latest = run.write_parts("t", df, F.col("m"), [202401, 202402], latest="m")
        run.commit()
    state = run_state.State(spark, tmp_dir)
    assert latest == 202402 and sorted(state.parts("t")) == ["202402"]
    assert sorted(tuple(r) for r in state.read_parts("t", rows.schema).collect()) == [(1, 202402), (2, 202402)]
    by_part = state.read_by_part("t", rows.schema)
    assert [r["__part"] for r in by_part.collect()] == [202402, 202402]


def test_shared_folder_is_required_outside_local_mode(spark, monkeypatch):
    from types import SimpleNamespace

    import pytest

    from ledgerline import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(RuntimeError):
        session.shared_dir(fake)


def test_arrow_file_system_knows_hadoop_names(monkeypatch, tmp_dir):
    import pyarrow.fs

    from ledgerline import session
    asked = []
    monkeypatch.setattr(pyarrow.fs, "FileSystem", type("FS", (), {"from_uri": staticmethod(lambda uri: asked.append(uri) or (None, uri))}))
    for uri in ("s3a://bucket/a b", "hdfs://host:1/x", "file:///tmp/x", "/tmp/x"):
        session.arrow_file_system(uri)
    assert asked == ["s3://bucket/a b", "hdfs://host:1/x", "file:///tmp/x", "/tmp/x"]
