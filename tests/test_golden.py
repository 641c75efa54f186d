"""Golden values: the published output of the banks run, and a transaction file."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ledgerline.operators import fx
from ledgerline.sources.files import ingest_csv_dir

# Fixed values, published output of the banks run: rank, name, USD, EUR, GBP, INR.
BANKS = [
    (1, "JPMorgan Chase", 432.9, 402.6, 346.32, 35909.06),
    (2, "Bank of America", 231.5, 215.3, 185.2, 19202.92),
    (3, "Industrial and Commercial Bank of China", 194.5, 180.89, 155.6, 16133.78),
    (4, "Agricultural Bank of China", 160.6, 149.36, 128.48, 13321.77),
    (5, "HDFC Bank", 157.9, 146.85, 126.32, 13097.8),
    (6, "Wells Fargo", 155.8, 144.89, 124.64, 12923.61),
    (7, "HSBC Holdings PLC", 148.9, 138.48, 119.12, 12351.26),
    (8, "Morgan Stanley", 140.8, 130.94, 112.64, 11679.36),
    (9, "China Construction Bank", 139.8, 130.01, 111.84, 11596.41),
    (10, "Bank of China", 136.8, 127.22, 109.44, 11347.56),
]

# Own rows in the shape of a bank's export: CRLF, no newline at the end, one account twice.
TRX_CSV = "\r\n".join([
    "transaction_id,account_id,transaction_date,amount,transaction_type,branch_id",
    "501,71,03-05-2023 09:15:00,1200,Deposit,2",
    "502,72,03-05-2023 18:40:00,75,Payment,1",
    "503,71,04-05-2023 07:05:30,310,Withdrawal,2",
    "504,73,05-05-2023 00:00:00,45000,Transfer,3",
    "505,74,05-05-2023 23:59:59,8,Deposit,1",
])


def _banks(spark):
    return spark.createDataFrame([b[:3] for b in BANKS],
                                 "Rank long, Country string, MC_USD_Billion double")


def test_fx_golden_values(spark):
    out = fx.fx_convert(_banks(spark), fx.rates_frame(spark)).orderBy("Rank").collect()
    got = [(r.Rank, r.Country, r.MC_USD_Billion, r.MC_EUR_Billion, r.MC_GBP_Billion,
            r.MC_INR_Billion) for r in out]
    assert got == BANKS


def test_avg_gbp_and_limit5(spark):
    conv = fx.fx_convert(_banks(spark), fx.rates_frame(spark))
    assert round(fx.average(conv, "MC_GBP_Billion", "a").first()["a"], 2) == 151.96
    names = [r.Country for r in fx.first_by_rank(conv, 5).collect()]
    assert names == [b[1] for b in BANKS[:5]]


def test_rates_last_wins_and_missing_raises(spark):
    rates = spark.createDataFrame([("EUR", 0.5), ("GBP", 0.8), ("EUR", 0.93)],
                                  fx.RATE_SCHEMA).coalesce(1)
    assert fx.rate_lookup(rates) == {"EUR": 0.93, "GBP": 0.8}
    many = spark.range(20_000).selectExpr("concat('X', id) Currency", "1.0D Rate").unionByName(rates)
    assert fx.rate_lookup(many)["GBP"] == 0.8
    try:
        fx.fx_convert(_banks(spark), rates)
    except KeyError as e:
        assert "INR" in str(e)
    else:
        raise AssertionError("missing rate must raise")


def test_transaction_file_golden(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "transaction.csv"), "w", newline="") as f:
        f.write(TRX_CSV)
    good, bad_rows, bad_files = ingest_csv_dir(spark, tmp_dir, "2024-02-01 00:00:00")
    assert bad_rows.count() == 0 and bad_files.count() == 0
    by_day = {r.d.isoformat(): (r.n, r.s) for r in good.groupBy(
        F.to_date("transaction_date").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s")).collect()}
    assert by_day == {"2023-05-03": (2, 1275.0), "2023-05-04": (1, 310.0), "2023-05-05": (2, 45008.0)}
    by_type = {r.transaction_type: r.s for r in good.groupBy("transaction_type").agg(
        F.sum("amount").alias("s")).collect()}
    assert by_type == {"Deposit": 1208.0, "Payment": 75.0, "Withdrawal": 310.0, "Transfer": 45000.0}
    first = good.where("transaction_id = 503").first()
    assert str(first.transaction_date) == "2023-05-04 07:05:30"
    assert first.dtmcrt == first.transaction_date
