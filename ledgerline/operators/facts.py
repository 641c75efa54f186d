"""Fact load: ``FactTransaction`` from staged transactions.

Semantics kept from the reference: a transaction is loaded only if its
account, branch and day exist in the core (inner joins drop orphans), and
the version kept per transaction id is ranked *after* those joins, so an
orphaned newest version falls back to the newest valid one.

Plan shape: keys already loaded are removed first (keys are independent, so
only new ones are joined, shuffled and ranked); account and branch membership
are semi joins (no fan-out), or, for accounts, an anti join with the stored orphans; the date key comes from a join with the bounded
date dimension; then one shuffle on the transaction id ranks versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import ntz
from ledgerline.functions.money import to_money
from ledgerline.operators.dedup import latest_per_key, latest_transaction_order
from ledgerline.operators.joins import anti_new_keys, calendar, semi_keys


def orphan_accounts(txn: DataFrame, dim_account: DataFrame) -> DataFrame:
    """``(__orphan)``: the accounts of ``txn`` that the core lacks, each once. Only distinct keys are
    shuffled for it, and there are few orphans: joined with them, the transactions need not be shuffled."""
    return anti_new_keys(txn.select(F.col("account_id").alias("__orphan")).distinct(), dim_account, "__orphan", "AccountID")


def valid_transactions(txn: DataFrame, dim_account: DataFrame, dim_branch: DataFrame,
                       dim_date: DataFrame, orphans: DataFrame | None = None) -> DataFrame:
    """Staged transactions whose account, branch and day are in the core,
    with the day key ``TransactionDateID`` added. ``orphans``: the stored ``orphan_accounts``."""
    t = txn.where(F.col("transaction_id").isNotNull())
    t = (semi_keys(t, dim_account, "account_id", "AccountID") if orphans is None
         else anti_new_keys(t, orphans, "account_id", "__orphan"))
    t = semi_keys(t, dim_branch, "branch_id", "BranchID")
    return t.join(calendar(dim_date, "__day", "TransactionDateID"),
                   F.to_date("transaction_date") == F.col("__day"), "inner").drop("__day")


def fact_rows(t: DataFrame) -> DataFrame:
    return t.select(
        F.col("transaction_id").alias("TransactionID"),
        F.col("account_id").alias("AccountID"),
        F.col("TransactionDateID"),
        to_money("amount").alias("Amount"),
        F.upper("transaction_type").alias("TransactionType"),
        F.col("branch_id").alias("BranchID"),
    )


def fact_transaction(txn_raw: DataFrame, dim_account: DataFrame, dim_branch: DataFrame,
                     dim_date: DataFrame, batch_ts: str,
                     target: DataFrame | None = None, orphans: DataFrame | None = None) -> DataFrame:
    """New ``FactTransaction`` rows, one per transaction id."""
    if target is not None:
        txn_raw = anti_new_keys(txn_raw, target, "transaction_id", "TransactionID")
    t = valid_transactions(txn_raw, dim_account, dim_branch, dim_date, orphans)
    t = latest_per_key(t, "transaction_id", latest_transaction_order())
    return (fact_rows(t)
            .withColumn("dtmload", ntz(batch_ts))
            .withColumn("dtmupd", F.lit(None).cast("timestamp_ntz")))


def fact_rejects(txn_raw: DataFrame, dim_account: DataFrame, dim_branch: DataFrame,
                 dim_date: DataFrame, orphans: DataFrame | None = None) -> DataFrame:
    """Staged transactions the fact load drops, with ``reject_reason``: the
    first of null key, missing account, missing branch, missing day.

    Lookups are key sets (one row per key), so the left joins never fan
    out.
    """
    from ledgerline.operators.quality import tag_rejects

    if orphans is None:
        t = txn_raw.join(dim_account.select(F.col("AccountID").alias("__a")),
                         F.col("account_id") == F.col("__a"), "left")
        no_account = F.col("__a").isNull()
    else:
        t = txn_raw.join(orphans.select(F.col("__orphan").alias("__a")), F.col("account_id") == F.col("__a"), "left")
        no_account = F.col("account_id").isNull() | F.col("__a").isNotNull()
    t = t.join(dim_branch.select(F.col("BranchID").alias("__b")),
               F.col("branch_id") == F.col("__b"), "left")
    t = t.join(calendar(dim_date, "__d", "__date_id"),
               F.to_date("transaction_date") == F.col("__d"), "left")
    tagged = tag_rejects(t, [("null_key", F.col("transaction_id").isNull()),
                             ("no_account", no_account),
                             ("no_branch", F.col("__b").isNull()),
                             ("no_date", F.col("__d").isNull())])
    return (tagged.where(F.col("reject_reason").isNotNull())
                  .drop("__a", "__b", "__d", "__date_id"))
