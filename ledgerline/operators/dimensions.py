"""Core dimension loads: date, customer, branch, account.

Each builder turns staging rows into dimension rows. With a ``target`` it
returns only keys not yet in the target (``NOT IN`` semantics, see
``joins.anti_new_keys``). Every result has one row per key: staged copies
of a key are reduced to the latest one before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_parts, ntz
from ledgerline.functions.money import to_money
from ledgerline.operators.dedup import latest_per_key, staged_row_order
from ledgerline.operators.joins import anti_new_keys, calendar


def dim_date_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One row per day between the two date columns of a one-row frame.

    The result has at most 366 rows per year of the range, so it is a
    bounded broadcast side wherever it is joined.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi),
                                              F.expr("INTERVAL 1 DAY"))).alias("__d"))
    return days.select(*[c.alias(n) for n, c in date_parts(F.col("__d")).items()])


def dim_date_covering(*date_cols: tuple[DataFrame, str]) -> DataFrame:
    """Date dimension spanning every date found in the given columns.

    Lazy: the bounds are one row (a min and max per column, aggregated on the
    map side) inside the plan, and the calendar is generated from it.
    """
    bounds = None
    for df, c in date_cols:
        part = df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi"))
        bounds = part if bounds is None else bounds.unionByName(part)
    return dim_date_between(bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))


def _stamp(df: DataFrame, batch_ts: str) -> DataFrame:
    return (df.withColumn("dtmload", ntz(batch_ts))
              .withColumn("dtmupd", F.lit(None).cast("timestamp_ntz")))


def latest_staged(raw: DataFrame, key: str) -> DataFrame:
    """Reduce staged copies to one row per key (latest load wins)."""
    values = [c for c in raw.columns if c not in (key, "dtmload", "dtmcrt")]
    return latest_per_key(raw, key, staged_row_order(values))


def customer_rows(customer: DataFrame, city: DataFrame, state: DataFrame) -> DataFrame:
    """Customer flattened through city and state (left joins), upper-cased.

    Lookup tables are reduced to one row per key first so that duplicate
    staged cities or states cannot fan a customer out.
    """
    ci = latest_staged(city, "city_id").select(
        F.col("city_id").alias("__city_id"), "city_name", F.col("state_id").alias("__state_id"))
    st = latest_staged(state, "state_id").select(
        F.col("state_id").alias("__sid"), "state_name")
    ci = ci.join(st, F.col("__state_id") == F.col("__sid"), "left")
    j = customer.join(ci, F.col("city_id") == F.col("__city_id"), "left")
    return j.select(
        F.col("customer_id").alias("CustomerID"),
        F.upper("customer_name").alias("CustomerName"),
        F.upper("address").alias("Address"),
        F.upper("city_name").alias("CityName"),
        F.upper("state_name").alias("StateName"),
        F.col("age").alias("Age"),
        F.upper("gender").alias("Gender"),
        F.col("email").alias("Email"),
        F.col("dtmload").alias("__staged_at"),
    )


def dim_customer(customer_raw: DataFrame, city_raw: DataFrame, state_raw: DataFrame,
                 batch_ts: str, target: DataFrame | None = None) -> DataFrame:
    """New ``DimCustomer`` rows. Customers whose city or state is missing
    are not loaded (their names are NOT NULL); ``customer_rejects`` reports
    them."""
    c = customer_raw.where(F.col("customer_id").isNotNull())
    if target is not None:
        c = anti_new_keys(c, target, "customer_id", "CustomerID")
    rows = customer_rows(latest_staged(c, "customer_id"), city_raw, state_raw)
    rows = rows.where(F.col("CityName").isNotNull() & F.col("StateName").isNotNull())
    return _stamp(rows.drop("__staged_at"), batch_ts)


def customer_rejects(customer_raw: DataFrame, city_raw: DataFrame,
                     state_raw: DataFrame) -> DataFrame:
    """Customers the load leaves out, with the reason: ``(CustomerID,
    reject_reason)`` for a null key, a missing city or a missing state."""
    c = latest_staged(customer_raw.where(F.col("customer_id").isNotNull()), "customer_id")
    rows = customer_rows(c, city_raw, state_raw)
    missing = (rows.where(F.col("CityName").isNull() | F.col("StateName").isNull())
                   .select("CustomerID", F.when(F.col("CityName").isNull(), F.lit("no_city"))
                           .otherwise(F.lit("no_state")).alias("reject_reason")))
    null_keys = (customer_raw.where(F.col("customer_id").isNull())
                 .select(F.col("customer_id").alias("CustomerID"),
                         F.lit("null_key").alias("reject_reason")))
    return missing.unionByName(null_keys)


def branch_rows(branch: DataFrame) -> DataFrame:
    return branch.select(
        F.col("branch_id").alias("BranchID"),
        F.upper("branch_name").alias("BranchName"),
        F.upper("branch_location").alias("BranchLocation"),
    )


def dim_branch(branch_raw: DataFrame, batch_ts: str,
               target: DataFrame | None = None) -> DataFrame:
    """New ``DimBranch`` rows."""
    b = branch_raw.where(F.col("branch_id").isNotNull())
    if target is not None:
        b = anti_new_keys(b, target, "branch_id", "BranchID")
    return _stamp(branch_rows(latest_staged(b, "branch_id")), batch_ts)


def account_rows(account: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Accounts with their opening-date key; accounts whose opening day is
    missing from the date dimension drop out (inner join)."""
    j = account.join(calendar(dim_date, "__day", "DateOpenedID"), F.to_date("date_opened") == F.col("__day"), "inner")
    return j.select(
        F.col("account_id").alias("AccountID"),
        F.col("customer_id").alias("CustomerID"),
        F.upper("account_type").alias("AccountType"),
        to_money("balance").alias("Balance"),
        F.col("DateOpenedID"),
        F.upper("status").alias("Status"),
    )


def dim_account(account_raw: DataFrame, dim_date: DataFrame, batch_ts: str,
                target: DataFrame | None = None) -> DataFrame:
    """New ``DimAccount`` rows."""
    a = account_raw.where(F.col("account_id").isNotNull())
    if target is not None:
        a = anti_new_keys(a, target, "account_id", "AccountID")
    return _stamp(account_rows(latest_staged(a, "account_id"), dim_date), batch_ts)
