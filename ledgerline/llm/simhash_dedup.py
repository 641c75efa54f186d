"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints of 64 bits are linked when they differ in at most 4; documents reachable over
links form one component, named by its smallest doc_id.

Candidate search. A fingerprint is cut into three segments of 22, 21 and 21 bits. Each is a
word of the perfect binary (23, 12) Golay code, whose decoder maps any word to the one
codeword within 3 bits. The keys of a word are the codeword indices (12 bits) reached by
decoding it and all words one bit away: 1 key if the word is within 2 bits of a codeword, else
6. Two words at most 2 bits apart share a key, since some word is within one bit of both. Of 4
errors over three segments, either
  * segments 0 and 1 have at most 2 errors each: they share a pair of keys (golay, golay); or
  * one of them has 3 or 4, so that it and the third have at most 1 more between the other
    two: one of these is equal and the other within 1: they share (exact, golay).
So the buckets keyed by golay(0) x golay(1), and for i in (0, 1) by exact(i) x golay(2) and
golay(i) x exact(2), hold every linked pair at least once; nothing is capped or sampled.

Verification. Only distinct fingerprints are keyed, so copies never meet in a bucket. Buckets
of one are dropped in the JVM. A bucket emits a spanning forest of its verified links, not all
pairs, which is all that components need. Buckets above ``BUCKET_ROWS`` are cut into blocks
whose pairs are compared in tasks of their own.

Cases: a null text counts as the empty one; a text without words has fingerprint zero, linked
like any other; repeated rows share a fingerprint; a null doc_id is named by its component's
smallest non-null id, if any. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written
from ledgerline.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BUCKET_ROWS = 4096
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (first bit, bits)
GENERATOR = 0b101011100011  # x^11+x^9+x^7+x^6+x^5+x+1 of the Golay code


# --- fingerprints -----------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - shingle + 1)
    first, last = (ends - lengths)[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(first, last)], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        block = h[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


# --- Golay code -------------------------------------------------------------------------

def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: words of 23 bits modulo the generator polynomial."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where(r >> bit & 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


@lru_cache(maxsize=1)
def _cosets() -> np.ndarray:
    """(2048, 6) error patterns: decoding a word and its 23 neighbours reaches the codewords
    word ^ pattern. Rows of light cosets repeat their one pattern."""
    bits = np.int64(1) << np.arange(23, dtype=np.int64)
    leader = np.zeros(2048, dtype=np.int64)
    weight = np.full(2048, 9)
    layers = [np.zeros(1, dtype=np.int64)]
    for _ in range(3):
        layers.append(np.unique((layers[-1][:, None] | bits[None, :]).ravel()))
    for w, words in enumerate(layers):
        words = words[np.bitwise_count(words) == w]
        s = _remainder(words)
        leader[s], weight[s] = words, w
    assert (weight < 9).all()  # perfect code
    step = _remainder(bits)
    out = np.empty((2048, 6), dtype=np.int64)
    for s in range(2048):
        reached = {int(leader[s])} | {int(leader[s ^ step[i]] ^ bits[i]) for i in range(23)}
        assert len(reached) in (1, 6)
        out[s] = sorted(reached) if len(reached) == 6 else [leader[s]] * 6
    return out


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) codeword indices and whether each is the first of its kind in the row."""
    code = words[:, None] ^ _cosets()[_remainder(words)]
    index = code >> 11  # the code is systematic: the high 12 bits name the codeword
    first = np.ones(index.shape, dtype=bool)
    first[:, 1:] = index[:, 1:] != index[:, :1]
    return index, first


def bucket_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every bucket of the fingerprints ``fp`` (uint64)."""
    seg = [(fp >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    gol = [golay_keys(x) for x in seg]
    rows = np.arange(len(fp))
    at, keys = [], []

    def add(kind: int, key: np.ndarray, use: np.ndarray) -> None:
        r = np.broadcast_to(rows.reshape((-1,) + (1,) * (key.ndim - 1)), key.shape)
        at.append(r[use])
        keys.append((np.int64(kind) << 40) | key[use])

    (k0, u0), (k1, u1), (k2, u2) = gol
    add(0, k0[:, :, None] << 12 | k1[:, None, :], u0[:, :, None] & u1[:, None, :])
    for i, (k, u) in ((0, gol[0]), (1, gol[1])):
        add(1 + i, seg[i][:, None] << 12 | k2, u2)
        add(3 + i, k << 22 | seg[2][:, None], u)
    return np.concatenate(at), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy().astype(np.int64)
        for i in range(0, len(fp), 8192):
            part = fp[i:i + 8192]
            at, keys = bucket_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[at])], names=["key", "fp"])


# --- links inside buckets ---------------------------------------------------------------

def forest(fp: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning forest of the links between distinct fingerprints, as index pairs."""
    out, left = [], np.arange(len(fp))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]) <= radius
            if near.any():
                found = left[near]
                out.extend((int(x), int(y)) for y in found)
                queue.extend(found)
                left = left[~near]
    return out


def _bucket_links(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows sorted by key: pairs at distance 1, 2, ... in the same small bucket are compared
        column-wise; larger buckets one by one. An open bucket waits for the next batch."""
        held = None

        def links(pdf: pd.DataFrame) -> pd.DataFrame:
            key, fp = pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64)
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            small = np.repeat(size <= 8, size)
            a, b = [], []
            for d in range(1, 8):
                i = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
                if not len(i):
                    break
                i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= radius]
                a.append(fp[i])
                b.append(fp[i + d])
            for s, n in zip(start[size > 8], size[size > 8]):
                part = fp[s:s + n]
                if pairs := forest(part, radius):
                    i, j = np.array(pairs).T
                    a.append(part[i])
                    b.append(part[j])
            a, b = (np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64) for x in (a, b))
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            open_ = pdf["key"].to_numpy() == pdf["key"].iloc[-1] if len(pdf) else np.empty(0, bool)
            held = pdf[open_]
            if not open_.all():
                yield links(pdf[~open_])
        if held is not None and len(held):
            yield links(held)
    return run


def _block_links(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """One pair of blocks of a large bucket (or one block with itself)."""
        fp = pdf["fp"].to_numpy().view(np.uint64)
        pairs = np.array(forest(fp, radius), dtype=np.int64).reshape(-1, 2)
        a, b = fp[pairs[:, 0]].view(np.int64), fp[pairs[:, 1]].view(np.int64)
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return run


def links(distinct: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b) spanning links between distinct fingerprints (column ``fp``) within ``radius``."""
    if radius > RADIUS:
        raise ValueError(f"the three segments guarantee at most {RADIUS} bits")
    keyed = distinct.mapInArrow(_keyed, "key long, fp long")
    keyed = (keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
             .where("n > 1"))  # rows stay together and sorted by key
    keyed = written(keyed, "simhash-buckets")
    small = (keyed.where(F.col("n") <= bucket_rows).repartition("key").sortWithinPartitions("key")
             .select("key", "fp").mapInPandas(_bucket_links(radius), "a long, b long"))
    blocks = F.ceil(F.col("n") / bucket_rows)
    mine = F.pmod(F.xxhash64("fp"), blocks)
    large = (keyed.where(F.col("n") > bucket_rows).withColumn("mine", mine)
             .select("key", "fp", "mine", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
             .select("key", "fp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
             .groupBy("key", "i", "j").applyInPandas(_block_links(radius), "a long, b long"))
    return small.unionByName(large).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    fps = written(fingerprints(docs, shingle), "simhash-fps")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(names, "root").select(F.col("fp").alias("__fp"), "component_id")
    return fps.join(named, fps["fp"] == named["__fp"]).drop("__fp")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` without those that are not the smallest doc_id of their component. Rows that
    share a doc_id are one document and stay or go together; rows without one stay."""
    gone = (near_duplicates(docs, shingle, radius).where("component_id < doc_id")
            .select(F.col("doc_id").alias("__id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")


def op6_simhash_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
