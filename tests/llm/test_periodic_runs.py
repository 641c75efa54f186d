from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from support import DOCS, odd_documents, with_clashes, words

from ledgerline.llm import periodic_runs as R


def plain_runs(w):
    """Every stretch, every period, by definition."""
    n, out = len(w), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            stretch = w[i:j + q]
            smaller = any(all(stretch[k] == stretch[k + r] for k in range(len(stretch) - r)) for r in range(1, q))
            if len(stretch) >= max(24, 3 * q) and not smaller:
                out.add((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, repeat=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if repeat and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def in_runs(rng, parts=6):
    """Random words and runs, some of them touching, nested or with a period inside the period."""
    out = []
    for _ in range(parts):
        kind = rng.randrange(5)
        if kind == 0:
            out += [f"w{rng.randrange(6)}" for _ in range(rng.randrange(40))]
        elif kind == 4:
            inner = [f"w{rng.randrange(3)}" for _ in range(rng.randrange(1, 4))] * 9
            out += (inner + [f"z{rng.randrange(2)}"]) * 4
        else:
            period = [f"w{rng.randrange(4)}" for _ in range(rng.randrange(1, 14))]
            out += (period * 40)[:rng.randrange(1, 80)]
    return out


@pytest.mark.parametrize("seed", range(60))
def test_runs_against_definition(seed):
    rng = random.Random(seed)
    texts = [in_runs(rng) for _ in range(4)]
    names = sorted({w for t in texts for w in t})
    code = np.array([names.index(w) for t in texts for w in t], dtype=np.int32)
    assert R.runs(code, np.array([len(t) for t in texts])) == [plain_runs(t) for t in texts]


def test_segments_are_stable_and_hold_all_runs():
    rng = random.Random(1)
    text = [f"u{i}" for i in range(50)] + ["a", "b", "c"] * 10 + [f"v{i}" for i in range(30)] + ["a"] * 30
    names = sorted(set(text))
    code = np.array([names.index(w) for w in text], dtype=np.int32)
    assert R.segments(code, np.zeros(len(code), np.int64)) == [(50, 80), (110, 140)]
    rng.shuffle(text)
    assert R.segments(np.empty(0, np.int32), np.empty(0, np.int64)) == []


def test_long_uniform_text_is_scanned_once():
    assert R.scan(np.zeros(2_000_000, np.int32)) == [(0, 2_000_000, 1)]


def result(df, *repeat):
    got = R.periodic_runs(df, *repeat).collect()
    return sorted(map(tuple, got), key=repr)


def test_rows_against_definition(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(in_runs(rng)) if i % 2 else words(rng, rng.randrange(1, 90), 60)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((plain_row(*r) for r in rows), key=repr)
    assert sum(r[1] for r in want) > 50
    assert result(df, R.repeated_tail) == want
    assert result(df) == sorted((plain_row(*r, repeat=False) for r in rows), key=repr)


def test_hashed_word_by_word(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, " ".join(in_runs(rng))) for i in range(8)] + [(30, ""), (31, None)]
    text = R.pa.array([t for _, t in rows], R.pa.string())
    batch = R.pa.RecordBatch.from_arrays([R.pa.array([i for i, _ in rows]), text], names=["doc_id", "text"])
    whole = R._answers(batch, R.repeated_tail)
    monkeypatch.setattr(R, "JOIN_BYTES", 10)
    assert R._answers(batch, R.repeated_tail).equals(whole)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in odd_documents() if not t or len(t) < 6000]
    rows += [(50, "x " * 30), (50, "x " * 30), (51, "a b " * 40 + "c"), (None, "x " * 30), (52, "é\x00 ü\t" * 12)]
    long = "\n".join(["q r s"] * 9000)
    df = with_clashes(spark.createDataFrame([(*r, "en", None, 1) for r in rows], DOCS))
    assert result(df, R.repeated_tail) == sorted((plain_row(*r) for r in rows), key=repr)
    one = spark.createDataFrame([(77, long)], "doc_id long, text string")
    assert [tuple(r)[1:6] for r in R.periodic_runs(one).collect()] == [(1, 0, 27000, 3, 9_000_000)]
    assert R.periodic_runs(df.where("false")).count() == 0


def test_collapse_keeps_other_texts_and_columns(spark):
    rows = [(1, "go  " + "a b c " * 10 + "end", "en", None, 1), (2, " no  run ", "en", "s", 2), (3, None, None, None, None)]
    df = with_clashes(spark.createDataFrame(rows, DOCS))
    got = R.collapse_runs(df)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "go a b c end", 2: " no  run ", 3: None}
    assert got.drop("text").exceptAll(df.drop("text")).isEmpty()
