"""Run every registered query against its DuckDB oracle (manual tool).

    python tests/run_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_compare import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    extra = {}
    if os.environ.get("ORACLE_SESSION_TZ"):   # check results do not depend on it
        extra["spark.sql.session.timeZone"] = os.environ["ORACLE_SESSION_TZ"]
    if os.environ.get("ORACLE_PLAIN_SESSION") == "1":   # a session without our settings
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        for k, v in extra.items():
            b = b.config(k, v)
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", shuffle_partitions=8, extra=extra)
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sql:
                ok, msg = compare(df, con, sql[name])
            else:
                ok, msg = True, f"rows-only: {df.count()} rows"
        except Exception as e:  # report and go on
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t0:6.1f}s  {msg}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
