from __future__ import annotations

import random
from collections import Counter

import regex
from support import DOCS, odd_documents, with_clashes, words

from ledgerline.llm import decontaminate as D

BENCH = "item_id long, text string, len int"


def plain_words(t):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", (t or "").lower()).split()


def best_window(doc, item, k=5):
    k = min(k, len(item))
    m = len(item) - k + 1
    sh = lambda w: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    of_item, all_, best = Counter(sh(item)), sh(doc), (0, 0)
    for a in range(len(doc) - len(item) + 1):
        both = sum((Counter(all_[a:a + m]) & of_item).values())
        best = max(best, (both / (2 * m - both), -a))
    return best


def brute(docs, items):
    out = set()
    for i, t in {(r[0], r[1]) for r in docs}:
        for j, b in {(r[0], r[1]) for r in items}:
            w = plain_words(b)
            if w:
                sim, back = best_window(plain_words(t), w)
                if sim >= 0.8:
                    out.add((i, j, -back, round(sim, 9)))
    return out


def fixture():
    rng = random.Random(11)
    items = [(i, words(rng, rng.randrange(8, 40)), 0) for i in range(25)]
    items += [(90, "Short one.", 0), (91, "single", 0), (92, "", 0), (93, None, 0), (94, "x y x y x y x y x y x y", 0),
              (None, items[3][1], 0), (95, "...", 0)]
    docs = []
    for n in range(160):
        w = words(rng, rng.randrange(0, 60)).split()
        if n % 2:
            p = items[n % 25][1].split()
            if n % 3 == 1:
                p[rng.randrange(len(p))] = "edited"
            if n % 5 == 1:
                p.insert(rng.randrange(len(p)), "added")
            if n % 7 == 1:
                del p[0]
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + "!," for x in p] if n % 4 == 1 else p
        docs.append((n, " ".join(w), "en", "a", 1))
    docs += [(500, "a Short one. b", "en", "a", 1), (501, "a single b", "en", "a", 1), (502, "z " + "x y " * 30, "en", "a", 1)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    docs += odd_documents()
    got = D.contaminated(with_clashes(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(items, BENCH)).collect()
    rows = {(r["doc_id"], r["item_id"], r["start"], round(r["similarity"], 9)) for r in got}
    assert rows == brute(docs, items) and len(rows) == len(got) > 30
    assert all(r["distance"] <= D.RADIUS for r in got)


def test_shuffled_benchmark_gives_the_same(spark, monkeypatch):
    docs, items = fixture()
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)
    want = {tuple(r) for r in D.contaminated(d, b).collect()}
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in D.contaminated(d, b).collect()} == want


def test_fingerprint_bits(spark):
    hashes = [3, 1, -1, 2 ** 62, 7]
    got = spark.createDataFrame([(hashes,)], "h array<bigint>").select(D.simhash(D.F.col("h")).alias("f")).first()["f"]
    bits = [sum(x >> b & 1 for x in hashes) * 2 > len(hashes) for b in range(64)]
    assert got & (2 ** 64 - 1) == sum(1 << b for b, on in enumerate(bits) if on)


def test_clean_documents_and_empty_tables(spark):
    docs, items = fixture()
    df, b = with_clashes(spark.createDataFrame(docs, DOCS)), spark.createDataFrame(items, BENCH)
    bad = {i for i, *_ in brute(docs, items)}
    out = D.clean_documents(df, b)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in docs if r[0] not in bad)
    assert D.contaminated(df.where("false"), b).count() == 0
    assert D.contaminated(df, b.where("false")).count() == 0
    assert D.clean_documents(df, b.where("false")).count() == len(docs)


def test_documents_shorter_than_the_item(spark):
    rng = random.Random(12)
    items = [(i, words(rng, rng.randrange(3, 60)), 0) for i in range(40)] + [(90, "p q " * 12, 0)]
    docs = [(900, "p q " * 11, "en", "a", 1), (901, "p q", "en", "a", 1), (902, "p", "en", "a", 1)]
    for i, text, _ in items:
        w = text.split()
        for cut in (1, 2, 5, 9):
            docs += [(len(docs), " ".join(w[:-cut]), "en", "a", 1), (len(docs) + 1, " ".join(w[cut:]), "en", "a", 1)]
            edited = w[cut:]
            if edited:
                edited[rng.randrange(len(edited))] = "edited"
            docs.append((len(docs), " ".join(edited), "en", "a", 1))
    want = set()
    for i, text, *_ in docs:
        d = plain_words(text)
        for j, b, _ in items:
            w = plain_words(b)
            k = min(5, len(w))
            of_doc, of_item = (Counter(tuple(x[a:a + k]) for a in range(len(x) - k + 1)) for x in (d, w))
            both = sum((of_doc & of_item).values())
            similarity = both / (sum(of_doc.values()) + sum(of_item.values()) - both)
            if len(d) < len(w) and similarity >= 0.8:
                want.add((i, j, 0, len(d), round(similarity, 9)))
    sizes = {j: len(plain_words(b)) for j, b, _ in items}
    got = D.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()
    got = {(r["doc_id"], r["item_id"], r["start"], r["words"], round(r["similarity"], 9)) for r in got
           if r["words"] < sizes[r["item_id"]]}
    assert got == want and len(want) > 100
