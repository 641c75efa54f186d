from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F
from support import DOCS, odd_documents, with_clashes

from ledgerline.llm import mixing


def targets(sizes: dict, repeats=3, weights=(1, 2, 3)) -> dict:
    """Cap, reshare the excess by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > repeats * sizes[s]}
        if not full:
            return {**out, **share}
        for s in full:
            out[s] = repeats * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets_fixed_point(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {s: rng.choice([0, 1, 5, 40, 900, 10000]) for s in ["a", "b", "c", "d", "Z", "é", None]}
        got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        want = targets(sizes)
        for r in got.collect():
            assert abs(r["target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]])


def test_mix_close_to_targets_and_stable(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("x" * rng.randrange(1, 200)), None, "hot" if rng.random() < 0.4 else f"s{rng.randrange(6)}", 0)
            for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(df).collect()
    assert len(got) == 3000
    taken, size, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
        assert r["source_size"] >= r["size"]
    want = targets(dict(size))
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6
        assert abs(taken[s] - target[s]) <= 220
    again = mixing.mix(df.repartition(7)).collect()
    assert {(r["doc_id"], r["copies"]) for r in got} == {(r["doc_id"], r["copies"]) for r in again}


def test_odd_rows_and_rows_taken(spark):
    df = with_clashes(spark.createDataFrame(odd_documents(), DOCS))
    plan = mixing.mix(df).collect()
    assert sum(r["rows"] for r in plan) == df.count()
    assert all(r["copies"] == 0 for r in plan if r["size"] == 0)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert out.count() == sum(r["rows"] * r["copies"] for r in plan)
    empty = df.where("false")
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    only = df.where("text is null")
    assert [r["copies"] for r in mixing.mix(only).select("copies", F.lit(1)).collect()] == [0]


def test_long_document_at_the_cut_leaves_no_source_short(spark):
    rows = []
    for source in "abcde":
        rows += [(len(rows) + i, "x " * (90 + i % 20), None, source, 0) for i in range(600)]
        rows += [(len(rows), "x " * 20_000, None, source, 0)]
    df = spark.createDataFrame(rows, DOCS)
    for seed in ("mix", "s1", "s2", "s3"):
        plan = mixing.mix(df, seed=seed).collect()
        taken, target = defaultdict(int), {}
        for r in plan:
            assert 0 <= r["copies"] <= 3
            taken[r["source"]] += r["copies"] * r["size"]
            target[r["source"]] = r["target"]
        assert all(target[s] - taken[s] <= 110 for s in target)
    assert len(plan) == len(rows)
