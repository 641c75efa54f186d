from __future__ import annotations

import math
import random

import numpy as np

from ledgerline.llm import kdtree

SCHEMA = "vec_id long, embedding array<float>, label int, x int"


def brute(rows, k=20):
    vec = [(i, [math.floor(float(np.float32(c)) * 64) for c in v]) for i, v, *_ in rows
           if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for own, (q, x) in enumerate(vec):
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for n, (i, v) in enumerate(vec)
                            if n != own and len(v) == len(x))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(n=900, dim=6):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dim)], 0, 0) for i in range(n)]
    tie = [0.5] * dim
    rows += [(2000 + i, tie, 0, 0) for i in range(60)]  # ties
    rows += [(40, [9.0] * dim, 0, 0), (60, rows[60][1], 0, 0)]  # repeated ids
    rows += [(3000, None, 0, 0), (3020, [1.0, None] + [0.0] * 4, 0, 0), (3040, [float("nan")] * dim, 0, 0),
             (3060, [float("inf")] * dim, 0, 0), (None, tie, 0, 0), (4000, [1.0, 2.0], 0, 0), (4001, [1.0, -2.0], 0, 0),
             (5000, [], 0, 0), (5001, [], 0, 0)]
    return rows


def test_against_brute_force_over_shards_and_blocks(spark):
    df = spark.createDataFrame(vectors(), SCHEMA)
    got = kdtree.top_k(df, shard_rows=100, query_rows=10, leaf_rows=8)
    assert [c for c, _ in got.dtypes] == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(vectors())


def test_large_components_are_exact(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) * 3e7 for _ in range(3)], 0, 0) for i in range(60)]
    got = kdtree.top_k(spark.createDataFrame(rows, SCHEMA), k=5, shard_rows=20)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)


def test_tree_prunes_and_boxes_are_tight():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 50, (20, 4))
    points = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 1, (4000, 4)))
    tree = kdtree.KDTree(points, 32)
    opened = 0
    for n in range(len(tree.left)):
        a, b = tree.range[n]
        assert (tree.points[a:b].min(0) == tree.lo[n]).all() and (tree.points[a:b].max(0) == tree.hi[n]).all()
        opened += tree.left[n] < 0
    q, ids = points[:50], np.arange(4000)
    _, found, scores = kdtree.search(tree, ids, ids, q, ids[:50], np.full(50, -np.inf), 10)
    for n in range(50):
        s = points @ q[n]
        s[n] = -np.inf
        want = np.lexsort((ids, -s))[:10]
        assert (found[n * 10:n * 10 + 10] == want).all() and (scores[n * 10:n * 10 + 10] == s[want]).all()
    best = kdtree.KDTree.bounds(tree, q)
    assert (best[:, 0] >= (points @ q.T).max(axis=0)).all()


def test_every_row_is_a_candidate_and_equals_the_sql(spark):
    """Rows that share an id, with equal and other vectors, as queries and as candidates."""
    import duckdb

    rows = [(20, [1.0], 0, 0), (1, [0.1], 0, 0), (1, [5.0], 0, 0), (2, [1.0], 0, 0), (20, [3.0], 0, 0), (1, [5.0], 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, kdtree.top_k(df).collect()))
    assert got == brute(rows) and (20, 1, 1, 320 * 64) in got
    embeddings = df.toArrow()  # noqa: F841  read by the SQL
    assert sorted(duckdb.sql(kdtree.OP3_SQL).fetchall()) == got


def test_empty(spark):
    assert kdtree.top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert kdtree.top_k(spark.createDataFrame([(20, [1.0], 0, 0)], SCHEMA)).count() == 0
