"""Ranked lexical search by a dual tree.

Every item is a query; its score with a document is the sum over the item's terms (repeats
included) of term weight x saturated term frequency, all in integers (``op13_dual_tree`` gives the
formula). Only terms of items matter, so documents become sparse vectors over those.

Items. Median splits along the principal axis order the items; 16 neighbours are a group, 4
groups a parent group. Every node holds, for each term, the largest weight among its items.
Documents. A task reads its documents in blocks, orders a block by the item group that fits a
document best and how well it does, and builds leaves of 32 documents, branches of 16 leaves and
the block; every node holds, for each term, the largest value among its documents.
Search. The sum of the products of two nodes' maxima bounds every score between them from above.
A pair of nodes whose bound is below the weakest k-th score of the node's items is dropped with
all its pairs; others are opened, the items first and then the documents, and what is left is
scored exactly. Equal bounds stay, so ties are not lost. The k-th scores start from an exact
search over a sample of the documents (a thirty-second part by hash, which only serves as a lower
bound), grow while a task goes on, and the best k of all tasks are ranked again by Spark.

Sizes. Items are taken in hashed blocks of about 512 items and 65,536 (item, term) pairs; a
block is on the driver and with every task, and is searched over all documents in turn. A task
holds one block of documents and k rows for each item of the block.

Cases: null or blank texts have no terms: such documents count neither for N nor for any rank,
such items return no row. Rows that share an item_id are items of their own, each ranked from 1.
Repeated documents each take a rank; a null doc_id comes after all others of its score. Other
columns are not read. Without documents or items there is no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written
from ledgerline.llm.words import slices, starts, words

K = 10
ITEM_ROWS = 512
ITEM_PAIRS = 1 << 16
GROUP = 16  # items of a leaf of the item tree
PARENT = 4  # groups of a parent
LEAF = 32  # documents of a leaf
BRANCH = 16  # leaves of a branch
BLOCK = 4096  # documents searched together
SAMPLE = 32  # one document of so many gives the first k-th scores

VECTORS = "doc_id long, n long, terms array<int>, tf array<int>"

# Bytes of terms stand for themselves, A-Z for a-z, all other ASCII bytes separate.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:128] = [ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)]


# --- terms ------------------------------------------------------------------------------

def terms(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the rows of ``text``, one after the other, and how many each row has."""
    text = pc.fill_null(text, "")
    cuts = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
    raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)[cuts[0]:cuts[-1]] if len(cuts) else np.empty(0, np.uint8)
    plain = pa.StringArray.from_buffers(len(text), pa.py_buffer((cuts - cuts[0]).tobytes()), pa.py_buffer(_BYTES[raw].tobytes()))
    return words(plain)


def _counted(row: np.ndarray, code: np.ndarray, rows: int, kinds: int):
    """(terms, counts, how many per row) of the distinct (row, code)."""
    key, times = np.unique(row.astype(np.int64) * kinds + code, return_counts=True)
    return (key % kinds).astype(np.int32), times.astype(np.int32), np.bincount(key // kinds, minlength=rows)


def _lists(n: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(values))


def _vectors(vocabulary: pa.Array):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                flat, n = terms(batch.column("text"))
                code = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy()
                use = code >= 0
                row = np.repeat(np.arange(len(n)), n)
                t, tf, count = _counted(row[use], code[use], len(n), len(vocabulary))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), _lists(count, t), _lists(count, tf)],
                                                 names=["doc_id", "n", "terms", "tf"])
    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            flat, n = terms(batch.column("text"))
            rows = pc.take(batch.column("item"), pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays([rows, flat], names=["item", "term"])


# --- item tree --------------------------------------------------------------------------

def item_order(q: np.ndarray, leaf: int = GROUP) -> np.ndarray:
    """The rows of ``q`` in the order of median splits along the principal axis."""
    def split(rows: np.ndarray) -> list[np.ndarray]:
        if len(rows) <= leaf:
            return [rows]
        x = q[rows].astype(np.float64)
        x -= x.mean(axis=0)
        axis = x[np.argmax((x * x).sum(axis=1))].copy()
        for _ in range(8):
            axis = x.T @ (x @ axis)
            size = np.linalg.norm(axis)
            if not size:
                break
            axis /= size
        rows = rows[np.argsort(x @ axis, kind="stable")]
        half = -(-len(rows) // (2 * leaf)) * leaf  # whole leaves
        return split(rows[:half]) + split(rows[half:])
    return np.concatenate(split(np.arange(len(q))))


class ItemTree:
    """Items as rows of weights (term weight x repeats), in groups and parents of groups."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, items: int, kinds: int):
        q = np.zeros((items, kinds), dtype=np.int32)
        q[item, term] = weight
        self.order = item_order(q)
        self.items, self.kinds = items, kinds
        q = q[self.order]
        first = np.arange(0, items, GROUP)
        self.groups = [(a, min(a + GROUP, items)) for a in first.tolist()]
        self.top = np.maximum.reduceat(q, first, axis=0).astype(np.int64)  # maxima of the groups
        parents = np.arange(0, len(first), PARENT)
        self.above = np.maximum.reduceat(self.top, parents, axis=0)
        self.children = [range(a, min(a + PARENT, len(first))) for a in parents.tolist()]
        self.local, self.weights = [], []
        for a, b in self.groups:
            own = np.flatnonzero(q[a:b].any(axis=0))
            at = np.full(kinds, -1, dtype=np.int32)
            at[own] = np.arange(len(own))
            self.local.append(at)
            self.weights.append(np.ascontiguousarray(q[a:b, own].T.astype(np.int64)))


# --- document tree and search -----------------------------------------------------------

class _Best:
    """The k best (score, doc) of every item so far, and the k-th score known."""

    def __init__(self, items: int, k: int, least: np.ndarray):
        self.k, self.kth = k, np.maximum(least, 1)  # only scores above 0 count
        self.item = np.empty(0, np.int64)
        self.score, self.doc, self.null = (np.empty(0, t) for t in (np.int64, np.int64, bool))

    def add(self, item, score, doc, null) -> None:
        item, score = np.r_[self.item, item], np.r_[self.score, score]
        doc, null = np.r_[self.doc, doc], np.r_[self.null, null]
        order = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[order], score[order], doc[order], null[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        last = rank == self.k - 1
        self.kth[item[last]] = np.maximum(self.kth[item[last]], score[last])
        use = rank < self.k
        self.item, self.score, self.doc, self.null = item[use], score[use], doc[use], null[use]


def _node_maxima(node: np.ndarray, term: np.ndarray, value: np.ndarray, kinds: int):
    """(node, term, largest value), by node and term."""
    key = node.astype(np.int64) * kinds + term
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first] // kinds, key[first] % kinds, np.maximum.reduceat(value, first)


def _sums(row: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``x`` by the ascending row numbers ``row``."""
    out = np.zeros((rows, *x.shape[1:]), dtype=np.int64)
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(x, first, axis=0)
    return out


def search_block(tree: ItemTree, best: _Best, doc: np.ndarray, null: np.ndarray, n: np.ndarray,
                 term: np.ndarray, value: np.ndarray) -> int:
    """Add the documents of a block, ``n`` (term, value) each, to ``best``; how many scores were made."""
    docs = len(n)
    row = np.repeat(np.arange(docs), n)
    if not len(row):
        return 0
    # order: by the group of the highest bound, best documents first
    fit = np.stack([_sums(row, value * g[term], docs) for g in tree.top])
    group, high = fit.argmax(axis=0), fit.max(axis=0)
    place = np.empty(docs, dtype=np.int64)
    order = np.lexsort((-high, group))
    place[order] = np.arange(docs)
    by = np.argsort(place[row], kind="stable")
    row, term, value = place[row][by], term[by], value[by]
    doc, null = doc[order], null[order]
    at = starts(np.bincount(row, minlength=docs))
    at = np.r_[at, len(row)]
    leaf, leaf_term, leaf_value = _node_maxima(row // LEAF, term, value, tree.kinds)
    branch, branch_term, branch_value = _node_maxima(leaf // BRANCH, leaf_term, leaf_value, tree.kinds)
    _, whole_term, whole_value = _node_maxima(np.zeros(len(branch), np.int64), branch_term, branch_value, tree.kinds)
    branches, leaves = int(branch[-1]) + 1, int(leaf[-1]) + 1
    leaf_at = np.searchsorted(leaf, np.arange(leaves + 1))

    def weakest(g: int) -> int:
        a, b = tree.groups[g]
        return int(best.kth[a:b].min())

    scored = 0
    for p, children in enumerate(tree.children):
        if int((tree.above[p][whole_term] * whole_value).sum()) < min(map(weakest, children)):
            continue
        for g in children:
            if int((tree.top[g][whole_term] * whole_value).sum()) < weakest(g):
                continue
            bound = _sums(branch, tree.top[g][branch_term] * branch_value, branches)
            for b in np.argsort(-bound, kind="stable").tolist():
                if bound[b] < weakest(g):
                    break
                first, end = b * BRANCH, min((b + 1) * BRANCH, leaves)
                x, y = leaf_at[first], leaf_at[end]
                low = _sums(leaf[x:y] - first, tree.top[g][leaf_term[x:y]] * leaf_value[x:y], end - first)
                opened = np.flatnonzero(low >= weakest(g)) + first
                if len(opened):
                    scored += _score(tree, best, g, opened, docs, at, row, term, value, doc, null)
    return scored


def _score(tree, best, g, opened, docs, at, row, term, value, doc, null) -> int:
    """Exact scores of the documents of the leaves ``opened`` with the items of group ``g``."""
    a, b = tree.groups[g]
    use = np.concatenate([np.arange(at[i * LEAF], at[min((i + 1) * LEAF, docs)]) for i in opened.tolist()])
    local = tree.local[g][term[use]]
    use, local = use[local >= 0], local[local >= 0]
    if not len(use):
        return 0
    rows, dense = np.unique(row[use], return_inverse=True)
    scores = _sums(dense, tree.weights[g][local] * value[use][:, None], len(rows))
    r, i = np.nonzero(scores >= best.kth[a:b])
    if len(r):
        best.add(a + i, scores[r, i], doc[rows[r]], null[rows[r]])
    return scores.size


def _searched(tree: ItemTree, least: np.ndarray, total_docs: int, total_terms: int, k: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(tree.items, k, least[tree.order].copy())
        for whole in batches:
            for a in range(0, whole.num_rows, block):
                b = whole.slice(a, block)
                ids = b.column("doc_id")
                m = 25 + 75 * b.column("n").to_numpy() * total_docs // total_terms
                t, tf = b.column("terms"), b.column("tf")
                n = pc.list_value_length(t).to_numpy().astype(np.int64)
                tf = tf.flatten().to_numpy().astype(np.int64)
                value = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, n))
                search_block(tree, best, pc.fill_null(ids, 0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                             n, t.flatten().to_numpy().astype(np.int64), value)
        yield pa.RecordBatch.from_arrays([pa.array(tree.order[best.item], pa.int32()), pa.array(best.score),
                                          pa.array(best.doc, mask=best.null)], names=["pos", "score", "doc_id"])
    return run


def _block_top(docs: DataFrame, pairs: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of ``pairs``: (item, term, repeats) rows."""
    spark = docs.sparkSession
    items = sorted({p["item"] for p in pairs})
    place = {x: i for i, x in enumerate(items)}
    names = sorted({p["term"] for p in pairs})
    code = {x: i for i, x in enumerate(names)}
    item = np.array([place[p["item"]] for p in pairs])
    term = np.array([code[p["term"]] for p in pairs])
    times = np.array([p["times"] for p in pairs], dtype=np.int64)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors = written(d.mapInArrow(_vectors(pa.array(names, pa.string())), VECTORS).where("n > 0"), "dual-vectors")
    total = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    found = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()  # one row for each term
    df = np.zeros(len(names), dtype=np.int64)
    df[found["t"].to_numpy()] = found["count"].to_numpy()
    w = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    tree = ItemTree(item, term, times * w[term], len(items), len(names))

    def top(rows: DataFrame, least: np.ndarray) -> DataFrame:
        best = rows.mapInArrow(_searched(tree, least, total["docs"], total["terms"], k, BLOCK),
                               "pos int, score long, doc_id long")
        order = Window.partitionBy("pos").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    least = np.zeros(len(items), dtype=np.int64)
    sample = vectors.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    for r in top(sample, least).where(F.col("rank") == k).select("pos", "score").collect():  # one row for each item
        least[r["pos"]] = r["score"]
    at = spark.createDataFrame(list(enumerate(items)), "pos int, item long")
    return top(vectors, least).join(F.broadcast(at), "pos").select("item", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = K, item_rows: int = ITEM_ROWS, item_pairs: int = ITEM_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents with a score above 0 of every item."""
    own = written(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "dual-items")
    pairs = written(own.select("item", "text").mapInArrow(_item_terms, "item long, term string")
                    .groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")), "dual-pairs")
    size = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("item").alias("items")).first()
    blocks = max(1, -(-size["items"] // item_rows), -(-size["pairs"] // item_pairs))
    parts = []
    for b in range(blocks):
        block = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if block:
            part = _block_top(docs, block, k)
            parts.append(written(part, "dual-top") if blocks > 1 else part)
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_dual_tree(spark, sf_dir) -> DataFrame:
    """Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    lower-cased. With N documents that have a term, L terms in them, n terms and m = 25 + (75 n N
    div L) of one of them: weight w = floor(1000 ln((2 N + 2) / (2 df + 1))), score = the sum of
    w * (10^9 tf div (1000 tf + 8 m))."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
it AS (SELECT item_id, t, count(*) AS c FROM i GROUP BY item_id, t),
tot AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
x AS (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d),
tf AS (SELECT doc_id, n, t, count(*) AS tf FROM x WHERE t IN (SELECT t FROM it) GROUP BY doc_id, n, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, tot GROUP BY t, n_docs),
s AS (
  SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM it JOIN tf USING (t) JOIN w USING (t), tot GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
