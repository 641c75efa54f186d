"""Type-1 merges of staged changes into core tables.

Plain Parquet tables take no ``UPDATE``, so a merge returns the *new state*
of the target: every target row, with the update applied where a staged
change matched. Staged changes are first reduced to one row per key (the
latest staged copy wins) so a target row can never be matched twice; the
join is then one-to-one on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import ntz
from ledgerline.functions.money import to_money
from ledgerline.operators.dimensions import customer_rows, latest_staged
from ledgerline.operators.incremental import read_mark


def merge_type1(target: DataFrame, target_key: str, changes: DataFrame, change_key: str,
                assignments: dict[str, Column], batch_ts: str) -> DataFrame:
    """Overwrite ``assignments`` (target column -> expression over
    ``changes``) on matched keys and stamp ``dtmupd``; other rows and
    columns are kept. A change that sets null writes null."""
    ch = changes.select(F.col(change_key).alias("__key"),
                        *[e.alias(f"__new_{c}") for c, e in assignments.items()],
                        F.lit(True).alias("__hit"))
    j = target.join(ch, F.col(target_key) == F.col("__key"), "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = []
    for c in target.columns:
        if c in assignments:
            out.append(F.when(hit, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c))
        elif c == "dtmupd":
            out.append(F.when(hit, ntz(batch_ts)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def staged_after(raw: DataFrame, key: str, mark: str) -> DataFrame:
    """Staged rows loaded after ``mark``, all copies of a key."""
    return raw.where((F.col("dtmload") > ntz(mark)) & F.col(key).isNotNull())


def changes_after(raw: DataFrame, key: str, mark: str) -> DataFrame:
    """Staged rows loaded after ``mark``, one (latest) per key."""
    return latest_staged(staged_after(raw, key, mark), key)


def update_dim_customer(target: DataFrame, customer_raw: DataFrame, city_raw: DataFrame,
                        state_raw: DataFrame, batch_ts: str, mark: str | None = None) -> DataFrame:
    """All columns follow the source. A changed customer whose city or state is
    missing keeps its row (the names are NOT NULL); ``customer_rejects`` reports it."""
    mark = mark or read_mark(target)
    ch = customer_rows(changes_after(customer_raw, "customer_id", mark), city_raw, state_raw)
    ch = ch.where(F.col("CityName").isNotNull() & F.col("StateName").isNotNull())
    cols = ("CustomerName", "Address", "CityName", "StateName", "Age", "Gender", "Email")
    return merge_type1(target, "CustomerID", ch, "CustomerID",
                       {c: F.col(c) for c in cols}, batch_ts)


def update_dim_branch(target: DataFrame, branch_raw: DataFrame, batch_ts: str,
                      mark: str | None = None) -> DataFrame:
    mark = mark or read_mark(target)
    ch = changes_after(branch_raw, "branch_id", mark)
    return merge_type1(target, "BranchID", ch, "branch_id",
                       {"BranchName": F.upper("branch_name"),
                        "BranchLocation": F.upper("branch_location")}, batch_ts)


def update_dim_account(target: DataFrame, account_raw: DataFrame, batch_ts: str,
                       mark: str | None = None) -> DataFrame:
    """Type, balance and status follow the source; customer and opening
    day are never updated."""
    mark = mark or read_mark(target)
    ch = changes_after(account_raw, "account_id", mark)
    return merge_type1(target, "AccountID", ch, "account_id",
                       {"AccountType": F.upper("account_type"),
                        "Balance": to_money("balance"),
                        "Status": F.upper("status")}, batch_ts)


def update_fact_transaction(target: DataFrame, txn_raw: DataFrame, batch_ts: str,
                            mark: str | None = None) -> DataFrame:
    """Amount and type follow the source; account, day and branch never."""
    mark = mark or read_mark(target)
    ch = changes_after(txn_raw, "transaction_id", mark)
    return merge_type1(target, "TransactionID", ch, "transaction_id",
                       {"Amount": to_money("amount"),
                        "TransactionType": F.upper("transaction_type")}, batch_ts)
