"""Removal of repeated passages by overlapping windows of three lines.

Every run of three consecutive lines of a document is hashed. A window seen before - earlier
in the order (doc_id, digest of the text, position) - is a repeat; the lines covered by any
repeated window, overlapping windows merged, are removed. The first occurrence stays.

The first place of each window is a grouped minimum, combined on the map side, so a passage
shared by a third of all documents leaves each task as one row; windows seen once leave the
plan there. Only repeats travel back to their document, whose covered positions are one array
bounded by the document's own lines.

Cases: lines are compared exactly; a window of blank lines only never counts; a text of fewer
than three lines, empty or null, is returned as it is; a document whose lines are all covered
becomes the empty text; rows equal in doc_id and text are one document, so each of them gets
the same result; a null doc_id sorts first. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, own, table, written

WINDOW = 3


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, digest, positions): start positions of the repeated windows per document."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("digest"),
                        F.split("text", "\n", -1).alias("lines")).where(F.size("lines") >= window)
    starts = F.sequence(F.lit(0), F.size("lines") - window)
    key = F.transform(starts, lambda i: F.when(
        F.length(F.trim(F.array_join(F.slice(F.col("lines"), i + 1, window), ""))) > 0,
        F.md5(F.array_join(F.slice(F.col("lines"), i + 1, window), "\n"))))
    at = written(lines.select("doc_id", "digest", F.posexplode(key).alias("pos", "w"))
                 .where("w is not null").distinct(), "line-windows")
    place = F.struct("doc_id", "digest", "pos")
    first = (at.groupBy("w").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("w").alias("__w"), "first"))
    later = (at.join(first, at["w"] == first["__w"])
             .where(~place.eqNullSafe(F.col("first"))))
    return later.groupBy("doc_id", "digest").agg(F.collect_list("pos").alias("positions"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages removed from ``text`` and ``removed_lines`` added."""
    hits = repeated_windows(docs, window).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"),
        F.array_distinct(F.flatten(F.transform("positions", lambda p: F.sequence(p, p + window - 1))))
        .alias("__covered"))
    text, covered = docs["text"], hits["__covered"]
    j = docs.join(hits, (F.xxhash64(text) == hits["__digest"]) & docs["doc_id"].eqNullSafe(hits["__id"]), "left")
    lines = F.transform(F.split(text, "\n", -1), lambda line, i: F.when(~F.array_contains(covered, i), line))
    kept = F.array_join(lines, "\n")  # nulls, the covered lines, are left out
    return j.select(*[F.when(covered.isNull(), text).otherwise(kept).alias(c) if c == "text" else own(docs, c)
                      for c in docs.columns],
                    F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(fresh(docs, "removed_lines")))


def op4_line_dedup(spark, sf_dir) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines")


OP4_SQL = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(range(len(lines) - 2)) AS pos, lines FROM l WHERE len(lines) >= 3),
k AS (SELECT doc_id, pos, array_to_string(lines[pos + 1:pos + 3], chr(10)) AS win FROM w),
n AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS seen
      FROM k WHERE length(trim(replace(win, chr(10), ''), ' ')) > 0),
c AS (SELECT DISTINCT doc_id, pos + o.i AS pos FROM n, (VALUES (0), (1), (2)) AS o(i) WHERE seen > 1),
e AS (SELECT l.doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM l),
r AS (SELECT e.doc_id, string_agg(line, chr(10) ORDER BY e.pos) FILTER (WHERE c.pos IS NULL) AS kept,
             count(c.pos) AS removed
      FROM e LEFT JOIN c ON c.doc_id = e.doc_id AND c.pos = e.pos GROUP BY e.doc_id)
SELECT l.doc_id, CASE WHEN r.removed > 0 THEN coalesce(r.kept, '') ELSE l.text END AS text,
       CAST(coalesce(r.removed, 0) AS BIGINT) AS removed_lines
FROM l LEFT JOIN r USING (doc_id)
"""
