"""Currency conversion of market capitalisations (banks pipeline).

``MC_{CUR}_Billion = round(MC_USD_Billion * rate[CUR], 2)`` with numpy's
rounding (``rint`` of the value scaled by 100). The rate table is a small
configuration table: one row per currency, the last row of a repeated
currency wins, a missing currency is an error. The wanted rates are aggregated
from it, one value each, and applied as literals (no join at all in the plan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import round2_half_even

# The reference's exchange-rate file (currency, rate per USD).
DEFAULT_RATES = (("EUR", 0.93), ("GBP", 0.8), ("INR", 82.95))
TARGET_CURRENCIES = ("EUR", "GBP", "INR")
RATE_SCHEMA = "Currency string, Rate double"


def rates_frame(spark: SparkSession, rates: Sequence[tuple[str, float]] = DEFAULT_RATES) -> DataFrame:
    return spark.createDataFrame(list(rates), RATE_SCHEMA)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Rate CSV with header ``Currency,Rate``; no schema inference."""
    return spark.read.schema(RATE_SCHEMA).option("header", True).csv(path)


def rate_lookup(rates: DataFrame, currencies: Sequence[str] = TARGET_CURRENCIES) -> dict[str, float]:
    """The rates of the wanted currencies; of repeated ones the last row counts. One aggregate
    over the table: only the wanted currencies' rows reach the driver, one each."""
    rows = (rates.withColumn("__pos", F.monotonically_increasing_id())
            .where(F.col("Currency").isin(list(currencies)))
            .groupBy("Currency").agg(F.max_by("Rate", "__pos").alias("Rate")).collect())
    return {r["Currency"]: r["Rate"] for r in rows}


def fx_convert(banks: DataFrame, rates: DataFrame | dict,
               currencies: Sequence[str] = TARGET_CURRENCIES,
               usd_col: str = "MC_USD_Billion") -> DataFrame:
    """Add ``MC_{CUR}_Billion`` for each currency; raises ``KeyError`` when
    a currency has no rate."""
    lookup = rates if isinstance(rates, dict) else rate_lookup(rates, currencies)
    out = banks
    for cur in currencies:
        if lookup.get(cur) is None:
            raise KeyError(f"no exchange rate for {cur}")
        out = out.withColumn(f"MC_{cur}_Billion",
                             round2_half_even(F.col(usd_col) * F.lit(float(lookup[cur]))))
    return out


def banks_from_suppliers(supplier: DataFrame) -> DataFrame:
    """Test stand-in for the banks table: rank = supplier key, name =
    supplier name, market cap = account balance."""
    return supplier.select(F.col("s_suppkey").alias("Rank"),
                           F.col("s_name").alias("Country"),
                           F.col("s_acctbal").alias("MC_USD_Billion"))


def average(df: DataFrame, col: str, alias: str, digits: int = 6) -> DataFrame:
    """Mean of a column (``SELECT AVG(col)``), reported to ``digits``."""
    return df.agg(F.round(F.avg(col), digits).alias(alias))


def first_by_rank(df: DataFrame, n: int = 5, rank_col: str = "Rank",
                  cols: Sequence[str] = ("Country",)) -> DataFrame:
    """``SELECT cols ... LIMIT n`` with the order made explicit (top-n by
    rank: a partial top-k per task, then one small merge)."""
    return df.orderBy(F.col(rank_col).asc_nulls_last()).limit(n).select(*cols)
