from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerline.llm import common


def test_against_brute_force_with_coarse_buckets(spark, monkeypatch):
    monkeypatch.setattr(common, "PREFIX_ROWS", 4)  # three levels of prefixes
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(4)}", i, rng.randrange(100), rng.randrange(9))
            for i in range(600)]
    df = spark.createDataFrame(rows, "g string, id long, spread long, v long")
    got = common.running_total(df, ["g"], ["id"], "v", "upto", F.col("spread"), 100).collect()
    want, total = {}, {}
    for g, i, s, v in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        total[g] = total.get(g, 0) + v
        want[i] = total[g]
    assert {r["id"]: r["upto"] for r in got} == want
