"""Near-duplicates by SuperMinHash signatures.

A document's set holds its distinct 2-word shingles (words lower-cased in A-Z). Documents are
linked when 100 * |A and B| >= 80 * |A or B|; a component is named by its smallest doc_id.

Signature. Every element (the 64-bit hash of a shingle) deals the ranks 0, 1, 2, ... to the
components in the order of its own pseudo-random permutation (Fisher-Yates, one swap per rank)
and adds a random fraction to each rank; a component keeps the least value that it gets. Since
one element gives different ranks to different components, the components are negatively
correlated and the estimate of the similarity varies less than with independent hashes. Rank j
can lower no component whose value is below j, so a document stops as soon as all its
components are: after about m log(m) / n ranks for n elements. Every component still collides
with exactly the similarity.

Candidates. 160 components make 32 bands of 5; documents that share a band meet in its bucket.
A pair at the threshold shares no band with probability 3e-6 (0.85: 2e-8), less at higher
similarity. No bucket is capped:
  1. documents with equal sets are one class, and classes meet in buckets;
  2. every class of a bucket is compared with the bucket's first one, once for all bands;
  3. where the others of a bucket are not in one component then, they are compared among
     themselves across components, in blocks of a bounded number of shingles; a block returns
     the links that join components, not all pairs.
Every link is confirmed on the full sets. Components come from star contraction.

Cases: a null text counts as the empty one; without words the set is empty, n_shingles 0, and
the row is a component of its own; one word is the only shingle; repeated rows are one class; a
null doc_id is named by its component's smallest non-null id, if any, and is kept only if there
is none. Other columns are not read. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small, table, written
from ledgerline.llm.graph import components
from ledgerline.llm.words import slices, starts, words

SIMILARITY = 80  # per cent
COMPONENTS = 160
BANDS = 32
BLOCK_ELEMENTS = 400_000  # shingles of one block of a bucket
ELEMENTS = 32_768  # elements that take their ranks at a time

_GOLD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- sets -------------------------------------------------------------------------------

def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, one row after the other, and each row's number."""
    flat, n = words(pc.ascii_lower(text))
    if not len(flat):
        return np.empty(0, np.uint64), n
    coded = flat.dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    h = known[coded.indices.to_numpy()]
    row = np.repeat(np.arange(len(n)), n)
    with np.errstate(over="ignore"):
        pair = _mix(h[:-1] * np.uint64(_GOLD) + _mix(h[1:]))
        lone = _mix(h + np.uint64(1))
    inside = row[:-1] == row[1:]
    single = n[row] == 1
    x, at = np.r_[pair[inside], lone[single]], np.r_[row[:-1][inside], row[single]]
    order = np.argsort(x)
    order = order[np.argsort(at[order].astype(np.min_scalar_type(len(n))), kind="stable")]
    x, at = x[order], at[order]
    first = np.r_[True, (x[1:] != x[:-1]) | (at[1:] != at[:-1])]
    return x[first], np.bincount(at[first], minlength=len(n)).astype(np.int64)


# --- signatures -------------------------------------------------------------------------

def signatures(elements: np.ndarray, counts: np.ndarray, m: int = COMPONENTS) -> np.ndarray:
    """(rows, m) SuperMinHash values, rank << 32 | fraction, of rows of ``counts`` elements."""
    out = np.full((len(counts), m), np.int64(m) << 32)
    doc = np.repeat(np.arange(len(counts)), counts)
    for a in range(0, len(elements), ELEMENTS):
        d, x = doc[a:a + ELEMENTS], elements[a:a + ELEMENTS]
        first = d[0]
        _deal(out[first:d[-1] + 1], d - first, x, m)
    return out


def _deal(h: np.ndarray, doc: np.ndarray, x: np.ndarray, m: int) -> None:
    """Lower the values ``h`` by what the elements ``x`` of the rows ``doc`` give."""
    flat = h.reshape(-1)
    p = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32), (len(x), 1))
    open_ = np.arange(len(h))
    for j in range(m):
        open_ = open_[h[open_].max(axis=1) >= np.int64(j) << 32]
        if not len(open_):
            return
        live = np.zeros(len(h), bool)
        live[open_] = True
        use = live[doc]
        if not use.all():
            doc, x, p = doc[use], x[use], p[use]
        if not len(doc):
            return
        with np.errstate(over="ignore"):
            z = _mix(x + np.uint64((j + 1) * _GOLD & 0xFFFFFFFFFFFFFFFF))
        k = j + ((z & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(doc))
        at = p[rows, k].astype(np.int64)
        p[rows, k] = p[:, j]
        value = np.int64(j) << 32 | (z >> np.uint64(32)).astype(np.int64)
        np.minimum.at(flat, doc * m + at, value)


def band_keys(h: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """(rows, bands) bucket keys."""
    width = h.shape[1] // bands
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLD), (len(h), bands))
    with np.errstate(over="ignore"):
        for i in range(width):
            key = _mix(key * np.uint64(_GOLD | 1) + h[:, i:bands * width:width].astype(np.uint64))
    return key.view(np.int64)


def _digests(x: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128-bit digests of the sorted sets as two longs (null for empty sets)."""
    raw, at = x.tobytes(), starts(n).tolist()
    d = np.array([divmod(xxhash.xxh3_128_intdigest(raw[8 * a:8 * (a + k)]), 1 << 64)
                  for a, k in zip(at, n.tolist())], dtype=np.uint64).reshape(-1, 2)
    return tuple(pa.array(d[:, i].view(np.int64), mask=n == 0) for i in (0, 1))


def _lists(values: np.ndarray, n: np.ndarray, kind=None) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(values, kind))


def _signed(m: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                x, n = shingle_sets(batch.column("text"))
                d1, d2 = _digests(x, n)
                full = n > 0
                keys = band_keys(signatures(x, n[full], m), bands)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n), d1, d2, _lists(keys.ravel(), full * bands)],
                    names=["doc_id", "n", "d1", "d2", "keys"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            x, n = shingle_sets(batch.column("text"))
            d1, d2 = _digests(x, n)
            yield pa.RecordBatch.from_arrays([d1, d2, _lists(x.view(np.int64), n)], names=["d1", "d2", "items"])


# --- links ------------------------------------------------------------------------------

def _block_links(similarity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links across components in one pair of blocks of a bucket (or one block with itself)."""
        node, n = pdf["node"].to_numpy(), pdf["n"].to_numpy()
        own, part = np.unique(pdf["root"].to_numpy(), return_inverse=True)
        code = np.unique(np.concatenate(pdf["items"].to_list()), return_inverse=True)[1]
        at = starts(n)
        mark = np.zeros(code.max() + 1, dtype=np.int64)
        sizes = np.bincount(part)
        largest = int(sizes.argmax())
        a, b = [], []
        for i in np.argsort(sizes[part], kind="stable").tolist():
            if part[i] == largest:
                continue  # its pairs with others were seen from the others
            mine = code[at[i]:at[i] + n[i]]
            mark[mine] = 1
            shared = np.add.reduceat(mark[code], at)
            mark[mine] = 0
            near = np.flatnonzero((100 * shared >= similarity * (n + n[i] - shared)) & (part != part[i]))
            for j in near.tolist():
                if part[j] != part[i]:
                    a.append(node[i])
                    b.append(node[j])
                    gone, stays = (part[j], part[i]) if part[j] != largest else (part[i], part[j])
                    part[part == gone] = stays
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough."""
    sa = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    sb = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(sb, "b").join(sa, "a")
            .where(100 * F.least(F.size("x"), F.size("y")) >= similarity * F.greatest(F.size("x"), F.size("y")))
            .where(100 * both >= similarity * (F.size("x") + F.size("y") - both)).select("a", "b"))


def _rooted(df: DataFrame, links: DataFrame) -> DataFrame:
    """``df`` with the component ``root`` of its ``node``."""
    roots = components(links).select(F.col("node").alias("__node"), "root")
    return df.join(roots, df["node"] == roots["__node"], "left").withColumn("root", F.coalesce("root", "node")).drop("__node")


def near_duplicates(docs: DataFrame, similarity: int = SIMILARITY, m: int = COMPONENTS, bands: int = BANDS,
                    block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = d.mapInArrow(_signed(m, bands), "doc_id long, n long, d1 long, d2 long, keys array<long>")
    signed = written(signed.withColumn("row", F.monotonically_increasing_id()), "smh-signatures")
    # classes of equal sets; a class is named by its first row
    classes = written(signed.where("n > 0").groupBy("d1", "d2")
                      .agg(F.min("row").alias("node"), F.min("doc_id").alias("first"), F.max("n").alias("n")), "smh-classes")
    keyed = (signed.select(F.col("row").alias("node"), "keys").join(classes.select("node"), "node", "left_semi")
             .select("node", F.explode("keys").alias("key")))
    leaders = (keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
               .where("leader < last").select("key", "leader"))
    mates = written(keyed.join(leaders, "key").where("node <> leader"), "smh-buckets")
    star = written(mates.select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "smh-pairs")
    # the full sets of the classes that met another one, made again from one text of each
    met = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    wanted = written(classes.join(met, "node", "left_semi"), "smh-wanted")
    ids = wanted.select(F.col("first").alias("__id")).distinct()
    ids = small(ids, ids.count())
    found = (d.join(ids, F.equal_null(d["doc_id"], ids["__id"]), "left_semi").mapInArrow(_sets, "d1 long, d2 long, items array<long>")
             .join(wanted.select("d1", "d2", "node"), ["d1", "d2"]).dropDuplicates(["node"]).select("node", "items"))
    sets = written(found, "smh-sets")
    first = written(_confirmed(star, sets, similarity), "smh-links")
    # buckets whose other classes are in several components still
    rooted = _rooted(mates, first)
    rooted = written(rooted.join(wanted.select("node", "n"), "node"), "smh-rooted")
    apart = (rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.sum("n").alias("total"))
             .where("r0 <> r1").select("key", F.ceil(F.col("total") / block_elements).alias("blocks")))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    rest = (rooted.join(apart, "key").withColumn("mine", block)
            .select("key", "node", "root", "n", "mine",
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
            .select("key", "node", "root", "n", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
            .join(sets, "node").groupBy("key", "i", "j").applyInPandas(_block_links(similarity), "a long, b long"))
    links = first.unionByName(rest)
    rooted = _rooted(classes, links)
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("d1", "d2", F.col("component_id").alias("c"))
    out = signed.join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.equal_null("doc_id", "component_id"))


def op11_superminhash(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# Links from the sizes of all intersections; components by reachability.
OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
         ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, root.component_id, s.doc_id = root.component_id AS kept
FROM s JOIN root ON s.doc_id = root.doc_id
"""
