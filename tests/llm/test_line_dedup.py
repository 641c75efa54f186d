from __future__ import annotations

import random

from support import DOCS, odd_documents, with_clashes

from ledgerline.llm import line_dedup


def brute(rows, window=3):
    """Rows equal in id and text are one document; order by id (null first) and position."""
    from collections import defaultdict

    places = defaultdict(list)
    for i, t in set(rows):
        lines = (t or "").split("\n")
        if t is not None:
            for p in range(len(lines) - window + 1):
                w = "\n".join(lines[p:p + window])
                if w.replace("\n", "").strip(" "):
                    places[w].append(((i is not None, i or 0), p, t))
    later = defaultdict(set)
    for occ in places.values():
        for key, p, t in sorted(occ)[1:]:
            later[(key, t)].update(range(p, p + window))
    out = []
    for i, t in rows:
        gone = later.get(((i is not None, i or 0), t), set())
        out.append((i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone) if gone else t, len(gone)))
    return out


def key(rows):
    return sorted(rows, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", "long line"]) for _ in range(rng.randrange(0, 12))))
            for i in range(300)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert key(map(tuple, got)) == key(brute(rows))


def test_hot_passage_and_odd_rows(spark):
    passage = "\n".join(f"shared line {i} with words" for i in range(6))
    rows = [(1000 + i, f"head {i}\n{passage}\ntail {i}", "en", "a", 1) for i in range(500)]
    df = with_clashes(spark.createDataFrame(rows + odd_documents(), DOCS))
    out = line_dedup.dedup_lines(df)
    assert out.columns[:len(df.columns)] == df.columns and len(out.columns) == len(df.columns) + 1
    got = out.select("doc_id", "text", out.columns[-1]).collect()
    assert key(map(tuple, got)) == key(brute([(r[0], r[1]) for r in rows + odd_documents()]))
    assert sum(passage in (r["text"] or "") for r in got) == 1
    assert line_dedup.dedup_lines(df.where("false")).count() == 0
