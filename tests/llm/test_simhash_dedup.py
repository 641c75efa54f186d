from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from support import DOCS, odd_documents, with_clashes, words

from ledgerline.llm import simhash_dedup as S
from ledgerline.llm.graph import components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=4):
    fp = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    names = {}
    for n, (i, _) in enumerate(rows):
        r = find(n)
        names[r] = min((x for x in (names.get(r), i) if x is not None), default=None)
    return sorted(((i, f"{int(fp[n]):016x}", names[find(n)]) for n, (i, _) in enumerate(rows)), key=repr)


def result(df, **options):
    got = S.near_duplicates(df, **options).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("text", ["", None, "a", "A b\x0bC", "É À Z b c d  f\n\n g", " x y z w v", "    x"])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_any_four_errors_share_a_bucket():
    rng = np.random.default_rng(0)
    for _ in range(400):
        x = rng.integers(0, 2 ** 63, dtype=np.uint64)
        e = np.uint64(0)
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            e |= np.uint64(1) << np.uint64(b)
        a, b = (set(S.bucket_keys(np.array([v], dtype=np.uint64))[1].tolist()) for v in (x, x ^ e))
        assert a & b


def near_copies(n=250):
    rng = random.Random(6)
    base = [words(rng, 150).split() for _ in range(12)]
    rows = []
    for i in range(n):
        w = list(base[i % 3 if i % 2 else i % 12])
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, " ".join(w)))
    return rows


def test_components_against_brute_force(spark):
    rows = near_copies()
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_large_buckets_in_blocks(spark):
    rows = near_copies(150)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fps = S.fingerprints(df).select("fp").distinct()
    whole = {tuple(r) for r in components(S.links(fps)).collect()}
    assert {tuple(r) for r in components(S.links(fps, bucket_rows=3)).collect()} == whole


def test_odd_rows(spark):
    df = with_clashes(spark.createDataFrame(odd_documents(), DOCS))
    assert result(df) == brute([(r[0], r[1]) for r in odd_documents()])
    kept = S.one_per_group(df)
    assert kept.columns == df.columns
    named = [(i, c) for i, _, c in brute([(r[0], r[1]) for r in odd_documents()])]
    gone = {i for i, c in named if i is not None and c < i}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((i for i, _ in named if i not in gone), key=repr)
    assert S.near_duplicates(df.where("false")).count() == 0


def test_chain_of_sorted_nodes(spark):

    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2000, 1999), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1999: 1999, 2000: 1999}
