"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and
length >= max(24, 3 * q) that no neighbouring word extends with period q.

Splitting. Every word of a run occurs at least three times in it. A word that occurs less often
within its segment (at first the whole text) is in no run of that segment, so the segment is
split there; pieces below 24 words are dropped, and the pieces are counted and split again until
none changes. All texts of a batch are split together: a round sorts the positions of the
segments that changed in the last one. A run never leaves its segment, and a neighbour that
would extend it is in the segment too.

Lag scan. A stable segment is compared with itself at each lag q up to a third of its length.
A run has at least 2 * q matching positions in a row, hence two neighbouring ones among the
multiples of q; only where these match are all positions compared. That makes n / q look-ups
for each lag. A stretch found at several lags has the smallest one as its period, and once a run
covers its segment no larger lag has a run. The scan of one text is a task's work; texts are
independent and nothing is shuffled.

Cases: a null or blank text has no words and no run; a null doc_id leaves the words as they are
(see ``repeated_tail``); repeated rows are each answered; equal exponents go to the smallest start,
then period. Other columns are not read. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import table
from ledgerline.llm.words import slices, starts, words

LEAST_WORDS = 24
LEAST_TIMES = 3
JOIN_BYTES = 1 << 28  # joined texts of a slice beyond this are hashed word by word

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


# --- runs -------------------------------------------------------------------------------

def segments(code: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stable segments of the words ``code`` of the texts ``doc``."""
    at = np.arange(len(code))
    seg = doc.astype(np.int64)
    stable: list[tuple[int, int]] = []
    kinds = int(code.max()) + 1 if len(code) else 1
    while len(at):
        key = seg * kinds + code[at]
        order = np.argsort(key, kind="stable")
        new = np.r_[True, key[order][1:] != key[order][:-1]]
        group = np.cumsum(new) - 1
        rare = np.empty(len(at), dtype=bool)
        rare[order] = np.bincount(group)[group] < LEAST_TIMES
        bounds = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1], True])
        first, end = bounds[:-1], bounds[1:]
        whole = np.add.reduceat(rare, first) == 0
        stable += [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(first[whole], end[whole])
                   if b - a >= LEAST_WORDS]
        left = ~rare & np.repeat(~whole, end - first)
        at, old = at[left], seg[left]
        if not len(at):
            break
        cut = np.r_[True, (at[1:] != at[:-1] + 1) | (old[1:] != old[:-1])]
        seg = np.cumsum(cut) - 1
        long = (np.bincount(seg) >= LEAST_WORDS)[seg]
        at, seg = at[long], seg[long]
    return sorted(stable)


def scan(c: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one segment, by ascending period."""
    n, found = len(c), {}
    for q in range(1, n // LEAST_TIMES + 1):
        need = max(LEAST_WORDS, LEAST_TIMES * q)
        if need > n:
            break
        if 3 * q >= LEAST_WORDS:
            e = c[q::q] == c[:-q:q]
            if not (e[1:] & e[:-1]).any():
                continue
        edge = np.flatnonzero(np.diff(np.r_[np.int8(0), (c[q:] == c[:-q]).view(np.int8), np.int8(0)]))
        first, length = edge[::2], edge[1::2] - edge[::2] + q
        for i in np.flatnonzero(length >= need).tolist():
            found.setdefault((int(first[i]), int(length[i])), q)
        if (0, n) in found:
            break
    return [(a, b, q) for (a, b), q in found.items()]


def runs(code: np.ndarray, counts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) by start and period, of each text of a batch."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    base = starts(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    for a, b in segments(code, doc):
        d = int(doc[a])
        out[d] += [(a - int(base[d]) + s, n, q) for s, n, q in scan(code[a:b])]
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


# --- texts ------------------------------------------------------------------------------

def repeated_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p): words from a on repeat those of [a, a + p) in one document of ten."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _joined_sha256(flat: pa.Array, use: np.ndarray, counts: np.ndarray) -> list[str]:
    """SHA-256 of the words ``flat[use]`` of each text, joined by one blank."""
    ends = np.cumsum(counts)
    size = pc.binary_length(flat).to_numpy()
    if size[use].sum(dtype=np.int64) + len(use) <= JOIN_BYTES:
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), flat.take(pa.array(use)))
        joined = pc.binary_join(lists, " ")
        cuts = np.frombuffer(joined.buffers()[1], np.int32)[:len(counts) + 1].tolist()
        raw = memoryview(joined.buffers()[2] or b"")
        return [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cuts[:-1], cuts[1:])]
    out = []
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        sha = hashlib.sha256()
        for k, i in enumerate(use[a:b].tolist()):
            sha.update((b" " if k else b"") + flat[i].as_buffer().to_pybytes())
        out.append(sha.hexdigest())
    return out


def _answers(batch: pa.RecordBatch, repeat) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    flat, counts = words(batch.column("text"))
    use = np.arange(len(flat))
    base = starts(counts).tolist()
    for i, n in enumerate(counts.tolist()):
        if repeat and (tail := repeat(ids[i], n)):
            a, p = tail
            use[base[i] + a:base[i] + n] = base[i] + a + np.arange(n - a) % p
    code = flat.dictionary_encode().indices.to_numpy()[use] if len(flat) else np.empty(0, np.int32)
    found = runs(code, counts)
    keep = np.ones(len(use), dtype=bool)
    best, listed = [], []
    for i, own in enumerate(found):
        for s, n, q in own:
            keep[base[i] + s + q:base[i] + s + n] = False
        top = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if own else (None, None, None)
        best.append((*top, 1000 * top[1] // top[2] if own else None))
        listed.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest())
    doc = np.repeat(np.arange(len(counts)), counts)
    collapsed = _joined_sha256(flat, use[keep], np.bincount(doc[keep], minlength=len(counts)).astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array([len(x) for x in found], pa.int64()),
         *[pa.array([b[k] for b in best], pa.int64()) for k in range(4)], pa.array(listed), pa.array(collapsed)],
        names=[c.split()[0] for c in SCHEMA.split(", ")])


def periodic_runs(docs: DataFrame, repeat=None) -> DataFrame:
    """One row per row of ``docs``: its number of runs, the one of greatest exponent, digests of
    all runs and of the text without the repetitions. ``repeat(doc_id, n)`` may name a tail (a, p)
    that is made periodic before."""
    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                yield _answers(batch, repeat)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(answered, SCHEMA)


def _collapsed(text: pa.Array) -> pa.Array:
    flat, counts = words(text)
    code = flat.dictionary_encode().indices.to_numpy() if len(flat) else np.empty(0, np.int32)
    keep, base = np.ones(len(flat), dtype=bool), starts(counts).tolist()
    found = runs(code, counts)
    for i, own in enumerate(found):
        for s, n, q in own:
            keep[base[i] + s + q:base[i] + s + n] = False
    doc = np.repeat(np.arange(len(counts)), counts)
    left = np.bincount(doc[keep], minlength=len(counts))
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(left)].astype(np.int32)), flat.filter(pa.array(keep)))
    changed = pa.array([bool(x) for x in found])
    return pc.if_else(changed, pc.binary_join(lists, " "), text)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with every run of its ``text`` cut to its first period (words then joined by one
    blank); texts without a run, and all other columns, stay as they are."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, f"c{at}"):
                yield batch.set_column(at, f"c{at}", _collapsed(batch.column(at)))
    return plain.mapInArrow(run, plain.schema).toDF(*names)


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), repeated_tail)


# Positions of equal words give the lags; islands of neighbouring ones are the stretches.
OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                               lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h
  FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM d),
p AS (
  SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS cut, CASE WHEN n > 0 THEN g % n END AS a,
         CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
x AS (SELECT *, unnest(range(n)) AS i FROM p),
t AS (SELECT doc_id, i, w[1 + CASE WHEN cut AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM x),
m AS (SELECT l.doc_id, r.i - l.i AS q, l.i FROM t l JOIN t r ON l.doc_id = r.doc_id AND l.w = r.w AND l.i < r.i),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM m),
st AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM isl GROUP BY doc_id, q, k HAVING count(*) + q >= greatest(24, 3 * q)),
run AS (SELECT doc_id, s, n, min(q) AS q FROM st GROUP BY doc_id, s, n),
agg AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM run GROUP BY doc_id),
best AS (
  SELECT doc_id, s, n, q FROM run
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(n AS DOUBLE) / q DESC, s, q) = 1),
gone AS (SELECT DISTINCT t.doc_id, t.i FROM t JOIN run r ON t.doc_id = r.doc_id AND t.i >= r.s + r.q AND t.i < r.s + r.n),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS txt FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(agg.n_runs, 0) AS n_runs, best.s AS start, best.n AS length, best.q AS period,
       1000 * best.n // best.q AS exponent_milli, sha256(coalesce(agg.txt, '')) AS runs_sha256,
       sha256(coalesce(kept.txt, '')) AS collapsed_sha256
FROM d LEFT JOIN agg USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
