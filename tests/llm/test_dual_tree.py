from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from support import DOCS, odd_documents, with_clashes, words

from ledgerline.llm import dual_tree as D

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """(item position, item_id, rank, doc_id, score) by definition."""
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    if not bags:
        return []
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for pos, (item_id, text) in enumerate(items):
        ranked = []
        for i, c, n in bags:
            m = 25 + 75 * n * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0:
                ranked.append((-s, i is None, i, s))
        ranked.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, r + 1, x[2], x[3]) for r, x in enumerate(ranked[:k])]
    return sorted(out, key=repr)


def result(spark, docs, items, **options):
    got = D.ranked(docs, items, **options).select("item_id", "rank", "doc_id", "score").collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("text", ["", None, "A-b_c", "É À1 Z\x00b\x7f𝔘x,y", " 1,000 ", "\x85 a\xa0b"])
def test_terms(text):
    flat, n = D.terms(pa.array(["pad it", text, "end"], pa.string())[1:])
    assert flat.to_pylist() == [*plain_terms(text), "end"]
    assert n.tolist() == [len(plain_terms(text)), 1]


def test_nodes_bound_all_scores_and_prune():
    """A block with few good documents: the right top 3 with far fewer scores than pairs."""
    rng = np.random.default_rng(0)
    kinds, items, docs = 300, 48, 2048
    item = np.repeat(np.arange(items), 6)
    term = np.concatenate([rng.choice(100, 6, replace=False) + 100 * (i % 3) for i in range(items)])
    weight = rng.integers(1, 9000, len(term)).astype(np.int64)
    tree = D.ItemTree(item, term, weight, items, kinds)
    assert sorted(tree.order.tolist()) == list(range(items))
    n = rng.integers(0, 6, docs)
    t = np.concatenate([np.sort(rng.choice(100, k, replace=False)) + 100 * (d % 3) for d, k in enumerate(n)]).astype(np.int64)
    v = np.where(np.repeat(np.arange(docs) % 50 == 0, n), 900_000, 20_000).astype(np.int64)
    best = D._Best(items, 3, np.zeros(items, np.int64))
    scored = D.search_block(tree, best, np.arange(docs), np.zeros(docs, bool), n, t, v)
    assert scored < items * docs / 3
    q = np.zeros((items, kinds), np.int64)
    q[item, term] = weight
    x = np.zeros((docs, kinds), np.int64)
    x[np.repeat(np.arange(docs), n), t] = v
    scores = q @ x.T
    got = sorted(zip(tree.order[best.item].tolist(), best.score.tolist(), best.doc.tolist()))
    want = []
    for i in range(items):
        order = np.lexsort((np.arange(docs), -scores[i]))[:3]
        want += [(i, int(scores[i, d]), int(d)) for d in order if scores[i, d] > 0]
    assert got == sorted(want)


@pytest.mark.parametrize("options", [{}, {"item_rows": 7}, {"k": 3, "item_pairs": 60}])
def test_against_brute_force(spark, options, monkeypatch):
    rng = random.Random(8)
    docs = [(i, words(rng, rng.randrange(80), 150) if i % 9 else "same text W1 w2, w3") for i in range(400)]
    items = [(i, words(rng, rng.randrange(1, 25), 200)) for i in range(40)] + [(90, "nothing_of!this"), (91, ""), (92, None)]
    monkeypatch.setattr(D, "LEAF", 4)
    monkeypatch.setattr(D, "BRANCH", 3)
    got = result(spark, spark.createDataFrame(docs, "doc_id long, text string"),
                 spark.createDataFrame(items, "item_id long, text string"), **options)
    assert got == brute(docs, items, options.get("k", 10))


def test_odd_rows(spark):
    rows = odd_documents()
    items = [(1, "W1 w2 w3 w4"), (1, "no id at all"), (2, "ünï one"), (None, "w7 w7"), (3, "w9"), (3, "w9"), (4, None), (5, "zzz")]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    bench = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    want = brute([(r[0], r[1]) for r in rows], items)
    assert result(spark, docs, bench) == want
    assert any(r[2] is None for r in want)
    assert result(spark, docs.where("false"), bench) == []
    assert result(spark, docs, bench.where("false")) == []
