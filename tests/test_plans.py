"""Plan shape: the properties the design relies on at scale, read from
``explain`` (partial limits before shuffles, pushed filters, aggregation
before joins, checked broadcasts)."""

from __future__ import annotations

import contextlib
import io
import os

from conftest import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from ledgerline.operators import incremental, marts
from ledgerline.operators.dedup import latest_per_key, latest_transaction_order
from ledgerline.operators.joins import SMALL_ROWS, small
from ledgerline.plans import scenario
from ledgerline.schemas import SPEC_BY_NAME


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_latest_per_key_limits_before_shuffle(spark):
    t = scenario.raw(spark, SF_SMALL)["transaction"]
    # a hot key: a third of all rows share one transaction id
    hot = t.withColumn("transaction_id", F.when(F.col("transaction_id") % 3 == 0, F.lit(-1))
                       .otherwise(F.col("transaction_id")))
    df = latest_per_key(hot, "transaction_id", latest_transaction_order())
    p = plan(df)
    tree = p.split("\n\n")[0]
    lines = tree.splitlines()
    # the partial WindowGroupLimit sits below the Exchange, the final one above
    ex = next(i for i, s in enumerate(lines) if "Exchange" in s)
    assert any("WindowGroupLimit" in s for s in lines[:ex])
    assert any("WindowGroupLimit" in s for s in lines[ex:])
    assert df.where(F.col("transaction_id") == -1).count() == 1


def test_extract_filter_reaches_parquet_scan(spark, tmp_dir):
    src = scenario.adapter.source_tables(spark, SF_SMALL)["account"]
    path = os.path.join(tmp_dir, "account_src")
    src.write.parquet(path)
    df = incremental.incremental_extract(spark.read.parquet(path), SPEC_BY_NAME["account"],
                                         "2000-01-01 00:00:00", "2002-01-01 00:00:00")
    p = plan(df)
    pushed = [s for s in p.splitlines() if "PushedFilters" in s][0]
    assert "Or(GreaterThan(dtmcrt" in pushed and "GreaterThan(dtmupd" in pushed
    read = [s for s in p.splitlines() if "ReadSchema" in s][0]
    assert "date_opened" in read and "dtmupd" in read


def test_mart_aggregates_fact_before_join(spark):
    core = scenario.first_load(spark, SF_SMALL)
    p = plan(marts.customer_mart(core.dim_customer, core.dim_account, core.fact), "simple")
    assert "keys=[AccountID" in p                 # fact reduced per account
    p2 = plan(marts.daily_summary(core.fact, core.dim_date), "simple")
    assert "keys=[TransactionDateID" in p2        # fact reduced per day


def test_broadcast_only_of_counted_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(10 ** 10).withColumnRenamed("id", "k")
        few = spark.range(100).withColumnRenamed("id", "k")
        j_few = plan(big.join(small(few, 100), "k"), "simple")
        j_many = plan(big.join(small(few, SMALL_ROWS + 1), "k"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in j_few
    assert "BroadcastHashJoin" not in j_many and "SortMergeJoin" in j_many


def test_loaded_keys_leave_before_ranking(spark):
    r = scenario.raw(spark, SF_SMALL)
    core = scenario.first_load(spark, SF_SMALL, raw_tables=r)
    old = spark.createDataFrame([(1,)], "TransactionID long")
    from ledgerline.operators.facts import fact_transaction
    df = fact_transaction(r["transaction"], core.dim_account, core.dim_branch, core.dim_date,
                          "2002-01-01 00:00:00", target=old)
    lines = plan(df, "simple").splitlines()
    window = min(i for i, s in enumerate(lines) if "Window" in s)
    anti = min(i for i, s in enumerate(lines) if "LeftAnti" in s)
    assert anti > window   # the anti join is below the ranking


def test_daily_bars_aggregate_by_hash(spark):
    from ledgerline.operators import bronze
    p = plan(bronze.bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")), "simple")
    assert "HashAggregate" in p and "SortAggregate" not in p and "ObjectHashAggregate" not in p


def test_dates_are_parsed_once(spark):
    from ledgerline.functions.dates import with_mixed_dates
    t = scenario.transaction_texts(spark, SF_SMALL).select("transaction_id", "date_text")
    df = with_mixed_dates(t, "date_text", "d").where("d is not null").where("d > '1995-01-01'")
    p = plan(df, "simple")
    assert p.index("Filter") < p.index("Generate explode")   # the filter does not cross the parse
    assert p.count("gettimestamp") == 2                      # a shape's pattern and its fallback, once


def test_hot_customer_is_split_by_aqe(spark, tmp_dir):
    """One customer owns a third of all accounts. With the core tables read
    back from storage (as the whole run does) and the customer table too
    large to broadcast, the mart join on CustomerID is a shuffle join that
    AQE splits for the hot key; the result is unchanged."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
            # tiny test data would otherwise be coalesced into one map task,
            # and a partition written by one task cannot be split
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        core = scenario.first_load(spark, SF_ORACLE)   # enough rows to split
        acct = core.dim_account.withColumn(
            "CustomerID", F.when(F.col("AccountID") % 3 == 0, F.lit(7)).otherwise(F.col("CustomerID")))
        tables = {"c": core.dim_customer, "a": acct, "f": core.fact}
        for name, df in tables.items():
            # several files, so the hot partition comes from several map tasks
            # (AQE splits a skewed partition along map outputs)
            df.repartition(8).write.parquet(os.path.join(tmp_dir, name))
        c, a, f = (spark.read.parquet(os.path.join(tmp_dir, n)) for n in ("c", "a", "f"))
        mart = marts.customer_mart(c, a, f)
        n = mart.count()
        hot = mart.where(F.col("CustomerID") == 7).count()
        mart.collect()
        final = plan(mart, "simple") + plan(mart, "formatted")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n == a.count() and hot >= n // 3
    assert "skew=true" in final


def test_day_extract_filter_reaches_scan(spark, tmp_dir):
    src = scenario.adapter.source_tables(spark, SF_SMALL)["customer"]
    path = os.path.join(tmp_dir, "customer_src")
    src.write.parquet(path)
    pred = incremental.changed_since_day("19991231")
    df = incremental.incremental_extract(spark.read.parquet(path), SPEC_BY_NAME["customer"],
                                         "19991231", "2002-01-01 00:00:00", pred)
    pushed = [s for s in plan(df).splitlines() if "PushedFilters" in s][0]
    assert "Or(GreaterThanOrEqual(dtmcrt" in pushed
    # same rows as the literal day comparison
    d = F.to_date(F.lit("19991231"), "yyyyMMdd")
    ref = spark.read.parquet(path).where(
        (F.to_date("dtmcrt") > d)
        | (F.to_date(F.coalesce("dtmupd", F.lit("1900-01-01").cast("timestamp_ntz"))) > d))
    assert df.count() == ref.count()


def test_bucketed_fact_is_not_exchanged(spark, tmp_dir):
    """New-key test and merge against a table bucketed by its key: only the changes are shuffled."""
    from ledgerline.operators import merge
    from ledgerline.operators.joins import anti_new_keys
    from ledgerline.sinks.bucketed import buckets_for, save_bucketed
    from ledgerline.sinks.writers import ensure_namespaces

    assert [buckets_for(n) for n in (0, 10 ** 7, 41 * 10 ** 6, 10 ** 11)] == [8, 8, 16, 32768]
    r = scenario.raw(spark, SF_SMALL)
    ensure_namespaces(spark, ("bucketed_test",))
    fact = save_bucketed(scenario.existing_core(spark, SF_SMALL, r)["FactTransaction"], "bucketed_test.fact",
                         os.path.join(tmp_dir, "fact"), "TransactionID", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (anti_new_keys(r["transaction"], fact, "transaction_id", "TransactionID"),
                   merge.update_fact_transaction(fact, r["transaction"], "2002-01-01 00:00:00", scenario.EXISTING_MARK)):
            tree = plan(df, "simple").splitlines()
            scan = next(i for i, s in enumerate(tree) if "bucketed_test.fact" in s)
            depth = len(tree[scan]) - len(tree[scan].lstrip(" :+-"))
            above = []   # the nodes between the scan and its join
            for s in reversed(tree[:scan]):
                d = len(s) - len(s.lstrip(" :+-"))
                if d < depth:
                    above.append(s)
                    depth = d
                if "SortMergeJoin" in s:
                    break
            assert any("SortMergeJoin" in s for s in above)
            assert not any("Exchange" in s for s in above), above
            assert "Bucketed: true" in plan(df, "formatted") or "SelectedBucketsCount: 16 out of 16" in plan(df, "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("DROP DATABASE bucketed_test CASCADE")
