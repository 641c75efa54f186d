"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of their row. Each shard builds a
KD-tree: median splits along the widest side, leaves of ``LEAF_ROWS``, a tight bounding box
per node. A query walks the tree best first by the largest inner product that a node's box
allows, and stops when no open box can reach its current k-th score. Boxes that could tie
are still opened, so ties go to the smaller id exactly.

The k-th score travels: every query first searches the shard it lives in, and starts in all
other shards from that k-th score, so they return only what can still be among the best.
Queries and shards meet in blocks of bounded size (the stated query set against all rows).

Components are floor(scale * x). Scores are exact: sums below 2^53 are computed in doubles,
larger ones in Python integers without pruning; a score beyond a long saturates.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do rows
without id; rows that share an id are rows of their own, each a candidate of all others and, if
the id asks, a query of its own, ranked from 1; only vectors of equal length are compared; fewer
candidates than k give fewer rows. Other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written

K = 20
SCALE = 64
QUERY_EVERY = 20
SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF_ROWS = 256
RESULT = "query_row long, query_id long, vec_id long, score long"


class KDTree:
    """Points in leaf order, and per node its box, its children or its range of points."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.lo, self.hi, self.left, self.right, self.range = [], [], [], [], []
        self.order = np.arange(len(points))
        self._build(points, 0, len(points), leaf_rows)
        self.points = points[self.order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, points: np.ndarray, a: int, b: int, leaf_rows: int) -> int:
        part = points[self.order[a:b]]
        lo, hi = part.min(axis=0), part.max(axis=0)
        node = len(self.left)
        for x, v in ((self.lo, lo), (self.hi, hi), (self.left, -1), (self.right, -1), (self.range, (a, b))):
            x.append(v)
        if b - a > leaf_rows and (hi > lo).any():
            side = int(np.argmax(hi - lo))
            mid = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(part[:, side], mid)]
            self.left[node] = self._build(points, a, a + mid, leaf_rows)
            self.right[node] = self._build(points, a + mid, b, leaf_rows)
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """(query, node): the largest inner product that the node's box allows."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T


def search(tree: KDTree, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray,
           floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best k per query among scores of at least ``floor``: (query number, id, score). ``rows``
    tells a query's own row from the others."""
    ids, rows = ids[tree.order], rows[tree.order]
    bounds = tree.bounds(queries)
    out_q, out_i, out_s = [], [], []
    for n, q in enumerate(queries):
        kth, me, bound = floor[n], query_rows[n], bounds[n]
        scores, found = np.empty(0), np.empty(0, dtype=np.int64)
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= kth:
            node = heapq.heappop(heap)[1]
            if tree.left[node] >= 0:
                for child in (tree.left[node], tree.right[node]):
                    if bound[child] >= kth:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            a, b = tree.range[node]
            s = tree.points[a:b] @ q
            near = s >= kth
            if near.any():
                i = ids[a:b][near]
                other = rows[a:b][near] != me
                scores, found = np.r_[scores, s[near][other]], np.r_[found, i[other]]
                if len(scores) >= k:
                    kth = max(kth, np.partition(scores, -k)[-k])
                    keep = scores >= kth
                    scores, found = scores[keep], found[keep]
        best = np.lexsort((found, -scores))[:k]
        out_q.append(np.full(len(best), n))
        out_i.append(found[best])
        out_s.append(scores[best])
    if not out_q:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s).astype(np.int64)


def _exact_search(points, ids, rows, queries, query_rows, k):
    """Large components: Python integers, every pair."""
    limit = 2 ** 63 - 1
    p = [[int(x) for x in row] for row in points]
    out = []
    for n, q in enumerate([[int(x) for x in row] for row in queries]):
        scored = sorted((-sum(a * b for a, b in zip(q, row)), int(i)) for row, i, r in zip(p, ids, rows) if r != query_rows[n])
        out += [(n, i, max(-limit - 1, min(limit, -s))) for s, i in scored[:k]]
    q, i, s = zip(*out) if out else ((), (), ())
    return np.array(q, dtype=np.int64), np.array(i, dtype=np.int64), np.array(s, dtype=np.int64)


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(len(column), dim)


def _top(points, ids, rows, queries, query_ids, query_rows, floor, k, leaf_rows) -> pd.DataFrame:
    reach = max(np.abs(points).max(initial=0.0), np.abs(queries).max(initial=0.0))
    if not len(points) or not len(queries):
        q, i, s = (np.empty(0, np.int64),) * 3
    elif reach * reach * max(1, points.shape[1]) >= 2.0 ** 53:
        q, i, s = _exact_search(points, ids, rows, queries, query_rows, k)
    else:
        q, i, s = search(KDTree(points, leaf_rows), ids, rows, queries, query_rows, floor, k)
    return pd.DataFrame({"query_row": query_rows[q] if len(q) else i, "query_id": query_ids[q] if len(q) else i,
                         "vec_id": i, "score": s})


def top_k(vectors: DataFrame, k: int = K, query_every: int = QUERY_EVERY, scale: int = SCALE,
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every id divisible by ``query_every``."""
    good = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    x = F.transform("embedding", lambda c: c.cast("double") * F.lit(float(scale)))
    v = (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
         .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.size("embedding").alias("dim"),
                 F.monotonically_increasing_id().alias("row")))
    v = written(v, "kd-vectors")
    sizes = {r["dim"]: r for r in v.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % query_every == 0, 1)).alias("q")).collect()}
    if not sizes:
        return v.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    per_dim = lambda f: F.element_at(F.create_map(*[F.lit(int(y)) for d, r in sizes.items() for y in (d, f(r))]),
                                     F.col("dim"))
    shards, blocks = per_dim(lambda r: r["n"] // shard_rows + 1), per_dim(lambda r: r["q"] // query_rows + 1)
    v = v.withColumn("shard", F.pmod(F.xxhash64("row"), shards).cast("int"))
    is_query = F.col("vec_id") % query_every == 0

    def home(pdf: pd.DataFrame) -> pd.DataFrame:
        points = np.floor(_matrix(pdf["x"], int(pdf["dim"].iloc[0])))
        ids, rows = pdf["vec_id"].to_numpy(), pdf["row"].to_numpy()
        mine = ids % query_every == 0
        return _top(points, ids, rows, points[mine], ids[mine], rows[mine], np.full(mine.sum(), -np.inf), k, leaf_rows)

    first = written(v.groupBy("dim", "shard").applyInPandas(home, RESULT), "kd-home")
    floors = (first.groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
              .where(F.col("n") >= k).select("query_row", F.col("kth").cast("double").alias("kth")))
    queries = (v.where(is_query).join(floors, F.col("row") == F.col("query_row"), "left")
               .select("dim", F.col("shard").alias("home"), "vec_id", "row", "x", "kth",
                       F.pmod(F.xxhash64("row", F.lit(1)), blocks).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), (shards - 1).cast("int"))).alias("shard"))
               .where("shard <> home"))
    rows = v.select(*[F.col(c).alias(c) for c in ("dim", "shard", "vec_id", "row", "x")],  # names of its own
                    F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("block"))

    def away(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        dim = int((c if len(c) else q)["dim"].iloc[0])
        return _top(np.floor(_matrix(c["x"], dim)), c["vec_id"].to_numpy(), c["row"].to_numpy(),
                    np.floor(_matrix(q["x"], dim)), q["vec_id"].to_numpy(), q["row"].to_numpy(),
                    q["kth"].fillna(-np.inf).to_numpy(), k, leaf_rows)

    keys = ("dim", "shard", "block")
    other = rows.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(away, RESULT)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return (first.unionByName(other).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_kdtree_topk(spark, sf_dir) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP3_SQL = r"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id,
             CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.r <> c.r AND len(q.x) = len(c.x)
      WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY s.r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
