"""Fixture rows and small helpers of the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Columns that share names with what operators use inside.
CLASHES = ("size", "digest", "rank", "fp", "g", "shard", "h", "y", "target", "__copy", "quality_score", "removed_lines",
           "toxicity", "replaced", "__found", "__old", "component_id", "a.b")


def words(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_documents() -> list[tuple]:
    """Nulls in every column, empty, blank, very long, repeated and tied rows."""
    rng = random.Random(5)
    long = "\n".join(words(rng, 12) for _ in range(2000))
    same = words(rng, 30)
    rows = [(1, same, "en", "a", 1), (1, same, "en", "a", 1), (2, same, "en", "b", 1), (3, same, None, None, None),
            (4, None, "en", "a", 0), (5, "", "en", "b", 0), (6, " \t\n ", "en", "c", 3), (7, long, "en", "a", len(long)),
            (8, "one", "en", None, 3), (None, "no id at all", "en", "a", 5), (None, same, "en", "a", 5),
            (9, "ünï çödé   x\x00y 𝔘", "de", "é", 5), (10, "w" * 5000, "en", "a", 5000)]
    rows += [(100 + i, words(rng, rng.randrange(1, 60)), "en", rng.choice("abc"), 1) for i in range(40)]
    return rows


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
