"""Money columns: fixed-point casts, signed amounts, half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.text import ci_equals
from ledgerline.schemas import MONEY

# Fixed value: the transaction type that adds to a balance; every other
# type (and a missing type) subtracts.
CREDIT_TYPE = "Deposit"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    """``CAST(x AS DECIMAL(18,2))``; overflow raises under ANSI mode."""
    return _col(c).cast(MONEY)


def signed_amount(type_col, amount_col) -> Column:
    """+amount for a deposit, -amount otherwise, null amount -> 0.

    The type is compared under the library's collation, so ``DEPOSIT`` (as the
    core layer stores it) or ``deposit `` counts as a deposit.
    """
    amt = _col(amount_col)
    return F.when(ci_equals(type_col, CREDIT_TYPE), F.coalesce(amt, F.lit(0).cast(MONEY))) \
        .otherwise(F.coalesce(-amt, F.lit(0).cast(MONEY)))


def round2_half_even(c) -> Column:
    """Round a double to 2 decimals the way ``numpy.round`` does:
    ``rint(x * 100) / 100`` (ties to even on the scaled value)."""
    return F.rint(_col(c) * F.lit(100.0)) / F.lit(100.0)
