"""Compare a Spark result with DuckDB SQL on the same Parquet tables:
row count, column names, and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

# ORACLE_EXACT=1 compares doubles bit for bit and decimals with their scale
EXACT = os.environ.get("ORACLE_EXACT") == "1"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if EXACT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v) if EXACT else round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]


def compare(df, con, sql) -> tuple[bool, str]:
    sc, srows = rows_of_spark(df)
    dc, drows = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duck={len(drows)}"
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    a, b = sorted(srows, key=key), sorted(drows, key=key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} duck={y}"
    return True, f"{len(srows)} rows match"
