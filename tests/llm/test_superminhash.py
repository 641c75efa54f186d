from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from support import DOCS, odd_documents, with_clashes, words

from ledgerline.llm import superminhash as S


def plain_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {(a, b) for a, b in zip(w, w[1:])} if len(w) > 1 else {tuple(w)} if w else set()


def brute(rows, similarity=80):
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= similarity * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    names = {}
    for n, (i, _) in enumerate(rows):
        r = find(n)
        names[r] = min((x for x in (names.get(r), i) if x is not None), default=None)
    return sorted(((i, len(sets[n]), names[find(n)], i == names[find(n)]) for n, (i, _) in enumerate(rows)), key=repr)


def result(df, **options):
    got = S.near_duplicates(df, **options).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(map(tuple, got), key=repr)


def near_copies(n=240, seed=6):
    """Copies with a few changed words: links at, just above and just below the threshold."""
    rng = random.Random(seed)
    base = [words(rng, k).split() for k in (12, 20, 45, 90, 150)]
    rows = []
    for i in range(n):
        w = list(base[i % len(base)])
        for _ in range(rng.randrange(1 + len(w) // 8)):
            w[rng.randrange(len(w))] = f"changed{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("text", ["", None, "a", "A b\x0bC", "É À Z b c d  f\n\n g", " x y z x y\x1cv ", "    x"])
def test_shingle_sets(text):
    x, n = S.shingle_sets(pa.array(["other words here", text, None, "a b"], pa.string()))
    assert n.tolist() == [2, len(plain_set(text)), 0, 1]
    assert len(x) == n.sum()


def test_plain_algorithm_gives_the_same_values():
    """Element by element, rank by rank, without stopping early."""
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2 ** 63, k, dtype=np.uint64) for k in (1, 3, 40, 700)]
    m = 16
    got = S.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), m)
    mask = (1 << 64) - 1
    for row, s in zip(got, sets):
        h = [m << 32] * m
        for x in s.tolist():
            p = list(range(m))
            for j in range(m):
                z = (x + (j + 1) * 0x9E3779B97F4A7C15) & mask
                z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mask
                z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
                z ^= z >> 31
                k = j + ((z & 0xFFFFFFFF) * (m - j) >> 32)
                p[j], p[k] = p[k], p[j]
                h[p[j]] = min(h[p[j]], j << 32 | z >> 32)
        assert row.tolist() == h


def test_lower_variance_than_independent_hashes():
    rng = np.random.default_rng(2)
    shares = []
    for _ in range(150):
        x = rng.integers(0, 2 ** 63, 30, dtype=np.uint64)
        h = S.signatures(np.r_[x[:25], x[5:]], np.array([25, 25]))
        shares.append((h[0] == h[1]).mean())
    j = 20 / 30
    assert abs(np.mean(shares) - j) < 0.01
    assert np.std(shares) < 0.85 * (j * (1 - j) / S.COMPONENTS) ** 0.5


def test_elements_in_several_parts(monkeypatch):
    rng = np.random.default_rng(3)
    x, n = rng.integers(0, 2 ** 63, 500, dtype=np.uint64), np.array([3, 0, 400, 97])
    whole = S.signatures(x, n)
    monkeypatch.setattr(S, "ELEMENTS", 37)
    assert (S.signatures(x, n) == whole).all()


def test_components_against_brute_force(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({r[2] for r in want}) > 10
    assert result(df) == want
    assert result(df, block_elements=300) == want  # buckets in blocks


def test_links_that_the_first_of_a_bucket_has_not(spark):
    """Two groups share so much that they share buckets, without a link between them."""
    rng = random.Random(9)
    common = words(rng, 60, 5000)
    tails = [words(rng, 22, 5000) for _ in range(3)]
    rows = [(i, f"{common} {tails[i % 3]} {'x' * (i // 3 + 1)}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert len({r[2] for r in want}) == 3
    assert result(df) == want
    assert result(df, block_elements=500) == want


def test_odd_rows(spark):
    rows = odd_documents()
    df = with_clashes(spark.createDataFrame(rows, DOCS))
    assert result(df) == brute([(r[0], r[1]) for r in rows])
    assert S.near_duplicates(df.where("false")).count() == 0


def test_equal_sets_of_other_texts_and_ids(spark):
    rows = [(7, "a b a b"), (3, "B a b A"), (3, "c"), (None, "C"), (9, "a"), (8, "a b c d e f"), (8, "z y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df) == brute(rows)
