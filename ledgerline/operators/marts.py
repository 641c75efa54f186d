"""Marts: customer balances and daily summary, plus their two
parameterised reads.

Both marts aggregate the fact *before* joining: the fact is reduced to
one row per account (customer mart) or per day (daily summary) with
map-side partial aggregation, so a hot account or day never reaches a
join or a single reducer as raw rows. Catalyst does not move an aggregate
below a join on its own, so the order is written here.

The reduced tables (``account_net``, ``day_total``) can be kept and brought up to
date by signed changes of the fact: a row as it was counts -1, as it is +1. Sums
of ``decimal(18,2)`` are exact, so the result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import signed_amount, to_money
from ledgerline.functions.text import COLLATION, ci_equals
from ledgerline.operators.joins import calendar
from ledgerline.schemas import MONEY

# One row per account with transactions, one row per day with transactions.
ACCOUNT_NET = "AccountID long, Net decimal(28,2)"
DAY_TOTAL = "TransactionDateID int, TotalTransactions long, Amount decimal(28,2)"


def _total(c) -> Column:
    return F.sum(c).cast("decimal(28,2)")


def account_net(fact: DataFrame) -> DataFrame:
    """Per account: deposits minus all other amounts (null amount -> 0)."""
    return fact.groupBy("AccountID").agg(_total(signed_amount("TransactionType", "Amount")).alias("Net"))


def add_account_changes(nets: DataFrame, changes: DataFrame) -> DataFrame:
    """``account_net`` after the signed ``changes`` (fact columns and ``__sign``)."""
    change = changes.groupBy("AccountID").agg(
        _total(signed_amount("TransactionType", "Amount") * F.col("__sign")).alias("Net"))
    return nets.unionByName(change).groupBy("AccountID").agg(_total("Net").alias("Net"))


def customer_balances(dim_customer: DataFrame, dim_account: DataFrame, nets: DataFrame) -> DataFrame:
    """``CustomerMart`` from the accounts' net amounts."""
    a = dim_account.select("AccountID", "CustomerID", "AccountType", "Balance")
    a = a.join(nets, "AccountID", "left")
    c = dim_customer.select("CustomerID", "CustomerName")
    j = a.join(c, "CustomerID", "inner")
    return j.select(
        "CustomerID", "CustomerName", "AccountID", "AccountType",
        F.col("Balance").cast(MONEY).alias("BaseBalance"),
        (F.col("Balance") + F.coalesce(F.col("Net"), F.lit(0).cast(MONEY)))
        .cast(MONEY).alias("CurrentBalance"),
    )


def customer_mart(dim_customer: DataFrame, dim_account: DataFrame,
                  fact: DataFrame) -> DataFrame:
    """``CustomerMart``: each account of each customer with its opening
    balance and balance after all transactions.

    Customers without accounts do not appear (inner join); accounts
    without transactions keep their balance (left join, sum -> 0).
    """
    return customer_balances(dim_customer, dim_account, account_net(fact))


def day_total(fact: DataFrame) -> DataFrame:
    """Per day key: number of transactions and their total amount (null amount -> 0)."""
    return fact.groupBy("TransactionDateID").agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        F.coalesce(_total("Amount"), F.lit(0).cast("decimal(28,2)")).alias("Amount"))


def add_day_changes(days: DataFrame, changes: DataFrame) -> DataFrame:
    """``day_total`` after the signed ``changes``; a day without transactions leaves it."""
    amount = F.coalesce(F.col("Amount"), F.lit(0).cast(MONEY)) * F.col("__sign")
    change = changes.groupBy("TransactionDateID").agg(
        F.sum("__sign").cast("long").alias("TotalTransactions"), _total(amount).alias("Amount"))
    return (days.unionByName(change).groupBy("TransactionDateID")
            .agg(F.sum("TotalTransactions").cast("long").alias("TotalTransactions"), _total("Amount").alias("Amount"))
            .where("TotalTransactions <> 0"))


def daily_totals(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``DailySummaryMart`` from the days' totals."""
    j = days.join(calendar(dim_date, "FullDate", "__id"), F.col("TransactionDateID") == F.col("__id"), "inner")
    return j.select(F.col("FullDate").alias("TransactionDate"), F.col("TotalTransactions"),
                    to_money("Amount").alias("TotalTransactionAmount"))


def daily_summary(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """``DailySummaryMart``: per calendar day, number of transactions and
    their total amount. Days missing from the date dimension drop out."""
    return daily_totals(day_total(fact), dim_date)


def daily_range_of_fact(fact_by_month: DataFrame, dim_date: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """The daily summary between two ``yyyyMMdd`` bounds straight from a fact whose partition
    column ``__part`` is the month: the days of the range, found in the date dimension when the
    query runs, choose the months that are read."""
    lo, hi = (F.to_date(F.lit(d), "yyyyMMdd") for d in (date_from, date_to))
    days = F.broadcast(dim_date.where(F.col("FullDate").between(lo, hi)).select(
        F.col("DateID").alias("__id"), "FullDate", (F.col("Year") * 100 + F.col("Month")).cast("int").alias("__month")))
    rows = fact_by_month.join(days, (F.col("__part") == F.col("__month")) & (F.col("TransactionDateID") == F.col("__id")))
    return rows.groupBy(F.col("FullDate").alias("TransactionDate")).agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        to_money(F.coalesce(F.sum("Amount"), F.lit(0))).alias("TotalTransactionAmount"))


def balance_per_customer(mart: DataFrame, name: str) -> DataFrame:
    """Rows of the customer mart for one customer name (under the library's collation)."""
    return mart.where(ci_equals("CustomerName", name))


def daily_summary_range(daily: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Daily summary rows between two ``yyyyMMdd`` bounds, both inclusive."""
    lo = F.to_date(F.lit(date_from), "yyyyMMdd")
    hi = F.to_date(F.lit(date_to), "yyyyMMdd")
    return daily.where(F.col("TransactionDate").between(lo, hi))


# Names of the two stored procedures.
BALANCE_PER_CUSTOMER = "BalancePerCustomer"
DAILY_SUMMARY_RANGE = "GetDailySummaryRange"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _table_function(df: DataFrame, name: str, parameters: str, condition: str) -> str:
    """Make ``name`` a table function of the session: the rows of ``df`` that meet ``condition``."""
    view = f"__{name}_rows"
    df.createOrReplaceTempView(view)
    df.sparkSession.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({_columns(df)}) "
                        f"RETURN SELECT {', '.join(df.columns)} FROM {view} WHERE {condition}")
    return name


def create_balance_per_customer(mart: DataFrame, name: str = BALANCE_PER_CUSTOMER) -> str:
    """The stored procedure as SQL: ``SELECT * FROM BalancePerCustomer('a name')``."""
    return _table_function(mart, name, "customer_name STRING",
                           f"collate(CustomerName, '{COLLATION}') = collate({name}.customer_name, '{COLLATION}')")


def create_daily_summary_range(daily: DataFrame, name: str = DAILY_SUMMARY_RANGE) -> str:
    """The stored procedure as SQL: ``SELECT * FROM GetDailySummaryRange('yyyyMMdd', 'yyyyMMdd')``."""
    return _table_function(daily, name, "date_from STRING, date_to STRING",
                           f"TransactionDate BETWEEN to_date({name}.date_from, 'yyyyMMdd') AND to_date({name}.date_to, 'yyyyMMdd')")
