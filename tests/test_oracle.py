"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

import __spark_entry__ as E

from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.oracle import SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    ok, msg = compare(df, con, SQL[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["CustomerID", "CustomerName", "AccountID", "AccountType",
                          "BaseBalance", "CurrentBalance"]
    assert df.count() > 0
