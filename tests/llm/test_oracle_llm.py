"""Operators that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_SMALL

from ledgerline.llm.registry import QUERIES, SQL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.sql(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda d: d[cols].sort_values(cols).reset_index(drop=True)
    got, want = key(got), key(want)
    assert len(got) == len(want) > 0
    assert got.equals(want.astype(got.dtypes.to_dict()))
