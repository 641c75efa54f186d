"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target share of the budget. Its documents are shuffled and queued; a copy
of a document has the virtual finish time (words of its source queued up to and including it)
/ (the source's target). All copies are put in one global order of finish times, cut where
the running total of words passes the budget. A long document at the cut can leave its source
short of the target, so each short source then takes further whole documents, always the longest
that still fits, until none does. The picks are found from the counts of equal sizes, so their
number does not matter.

DataFrame functions only. Documents are reduced to a narrow row (id, source, size, text
digest) before anything is shuffled. The two global orders (the queue of a source that may
hold a third of all rows, and the order of finish times) are range-sorted by an arithmetic
bucket: sums per bucket first, a prefix over the table of buckets, and only then windows, each
over the rows of one bucket. Two numbers reach the driver: the place of the cut.

Cases: a null text or one without words has size 0, and nothing is taken of it; a null
source is a source of its own, the last; rows equal in id, source and text are queued as one
unit and taken or left together; an empty table gives an empty result. Other columns of the
input are not read. Equal finish times are cut by the rank of the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, own, running_total, small, table, totals_before, word_count, written

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
ROWS_PER_BUCKET = 2000


def source_targets(sizes: DataFrame, budget_share: float = 1.0, max_repeats: int = MAX_REPEATS,
                   weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> + (rank, target).

    Weights repeat over the sources in code-point order, null last. A target stops at
    ``max_repeats`` times its source; the excess is shared again by weight among the others.
    That fixed point is found at once: in order of size per weight the first sources are
    full, and all others share the rest of the budget.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("rank", F.row_number().over(by_name).cast("long"))
         .withColumn("__w", w)
         .withColumn("__cap", F.col("source_size") * F.lit(float(max_repeats)))
         .withColumn("__r", F.col("__cap") / F.col("__w")))
    all_rows = Window.partitionBy()
    order = Window.orderBy("__r", "rank")
    first = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("__budget", F.sum("source_size").over(all_rows) * F.lit(float(budget_share)))
         .withColumn("__full", F.coalesce(F.sum("__cap").over(first), F.lit(0.0)))
         .withColumn("__open", F.sum("__w").over(all_rows)
                     - F.coalesce(F.sum("__w").over(first), F.lit(0.0)))
         .withColumn("__level", (F.col("__budget") - F.col("__full")) / F.col("__open"))
         .withColumn("__fits", F.col("__level") <= F.col("__r")))
    # the level of the first source that is not full holds for all after it
    level = F.min(F.when(F.col("__fits"), F.struct("__r", "rank", "__level"))).over(all_rows)
    s = s.withColumn("__at", level)
    capped = F.col("__at").isNull() | (F.struct("__r", "rank") < F.struct("__at.__r", "__at.rank"))
    return s.select("source", "source_size", "rank",
                    F.when(capped, F.col("__cap"))
                    .otherwise(F.col("__at.__level") * F.col("__w")).alias("target"))


def mix(docs: DataFrame, max_repeats: int = MAX_REPEATS, weights: tuple[int, ...] = WEIGHTS,
        seed: str = "mix") -> DataFrame:
    """One row per distinct (doc_id, source, text): ``doc_id, source, digest, rows, size,
    source_size, target, copies``. ``copies`` (0 to ``max_repeats``) is how often the mix takes
    each of its ``rows`` equal rows."""
    digest = F.xxhash64("text")
    units = written(
        docs.select("doc_id", "source", digest.alias("digest"), word_count(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "digest", "size").agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("words", F.col("size") * F.col("rows"))
        .withColumn("h", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                        F.lit(f":{seed}")))),
        "mix-units")
    n, total = units.agg(F.count(F.lit(1)), F.coalesce(F.sum("words"), F.lit(0))).first()
    by_source = written(units.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources")
    sources = by_source.count()
    targets = source_targets(by_source, max_repeats=max_repeats, weights=weights)
    digits = 1
    while 16 ** digits * ROWS_PER_BUCKET < n:
        digits += 1
    # leading hexadecimal digits: buckets follow the order of h itself
    spread = F.conv(F.substring("h", 1, digits), 16, 10).cast("long")
    # a hot source never gathers in one task: few sources are broadcast, a join of many is
    # split by AQE
    t = small(targets.withColumnRenamed("source", "__source"), sources)
    u = units.join(t, units["source"].eqNullSafe(t["__source"])).drop("__source")
    u = written(running_total(u, ["rank"], ["h", "doc_id", "digest"], "words", "queued",
                              spread, 16 ** digits), "mix-queue")

    def finish(copy):
        done = (copy * F.col("source_size") + F.col("queued")).cast("double")
        return F.when(F.col("target") > 0, done / F.col("target")).otherwise(F.lit(0.0))

    per_unit = max(1, n // ROWS_PER_BUCKET)
    copies = (u.where("words > 0")
              .select("rank", "words", F.explode(F.array(*[finish(F.lit(i)) for i in range(max_repeats)]))
                      .alias("finish"))
              .withColumn("bin", F.floor(F.col("finish") * per_unit)))
    # bins grow with the documents, so their prefix sums are taken in coarser bins above them
    bins = written(copies.groupBy("bin").agg(F.sum("words").alias("__sum")), "mix-bins")
    last_bin = bins.agg(F.max("bin")).first()[0] or 0
    edge = (bins.join(totals_before(bins, [], "bin", "before", last_bin + 1), "bin")
            .where(F.col("before") + F.col("__sum") > total)
            .agg(F.min(F.struct("bin", "before")).alias("e")).first()["e"])
    if edge is None:  # everything fits
        taken = F.lit(max_repeats)
    else:
        inside = (Window.partitionBy("bin").orderBy("finish", "rank")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        last = (copies.where(F.col("bin") == edge["bin"])
                .withColumn("upto", F.sum("words").over(inside) + edge["before"])
                .where(F.col("upto") <= total)
                .agg(F.max(F.struct("finish", "rank")).alias("e")).first()["e"])
        at, rank = (last["finish"], last["rank"]) if last else (edge["bin"] / per_unit, -1)
        taken = sum(F.when((finish(F.lit(i)) < at)
                           | ((finish(F.lit(i)) == at) & (F.col("rank") <= rank)), 1).otherwise(0)
                    for i in range(max_repeats))
    u = u.withColumn("copies", F.when(F.col("size") > 0, taken).otherwise(0).cast("int"))
    picks = written(_fill(u, max_repeats, sources, 16 ** digits - 1 - spread, 16 ** digits), "mix-fill")
    extra = small(picks, picks.count()).select(F.col("rank").alias("__rank"), F.col("doc_id").alias("__id"),
                                               F.col("digest").alias("__digest"), F.lit(1).alias("extra"))
    return (u.join(extra, (F.col("rank") == F.col("__rank")) & (F.col("digest") == F.col("__digest"))
                   & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
            .select("doc_id", "source", "digest", "rows", "size", "source_size", "target",
                    (F.col("copies") + F.coalesce("extra", F.lit(0))).alias("copies")))


def _fill(u: DataFrame, max_repeats: int, sources: int, spread, buckets: int) -> DataFrame:
    """(rank, doc_id, digest): the documents that short sources take beyond the cut, in falling
    order of (words, h, doc_id, digest); ``spread`` deals rows to ``buckets`` in that order of h."""
    gap = F.floor(F.first("target") - F.sum(F.col("words") * F.col("copies")))
    gaps = u.groupBy("rank").agg(gap.alias("gap")).where("gap > 0")
    more = (u.where((F.col("copies") < max_repeats) & (F.col("words") > 0))
            .join(small(gaps, sources), "rank").where("words <= gap")
            .select("rank", "gap", "words", "h", "doc_id", "digest"))
    classes = more.groupBy("rank", "words").agg(F.first("gap").alias("gap"), F.count(F.lit(1)).alias("n"))
    by_size = classes.groupBy("rank").agg(
        F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("words", "n")), asc=False).alias("sizes"))
    took = F.array().cast("array<struct<words:bigint,n:bigint,k:bigint>>")
    start = F.struct(F.col("gap"), took.alias("took"))

    def take(s, c):
        k = F.least(c["n"], F.floor(s["gap"] / c["words"]))
        row = F.struct(c["words"].alias("words"), c["n"].alias("n"), k.alias("k"))
        return F.struct((s["gap"] - k * c["words"]).alias("gap"),
                        F.when(k > 0, F.concat(s["took"], F.array(row))).otherwise(s["took"]).alias("took"))
    sizes = written(by_size.select("rank", F.inline(F.aggregate("sizes", start, take, lambda s: s["took"]))), "mix-sizes")
    of_size = small(sizes, sizes.count())
    taken = more.join(of_size, ["rank", "words"])
    # sizes taken in part: the first k, ranked in buckets
    part = running_total(taken.where("k < n").withColumn("one", F.lit(1)), ["rank", "words"],
                         [F.desc("h"), F.desc("doc_id"), F.desc("digest")], "one", "place", spread, buckets)
    keys = ("rank", "doc_id", "digest")
    return taken.where("k = n").select(*keys).unionByName(part.where("place <= k").select(*keys))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns unchanged."""
    plan = mix(docs, **options).where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"),
        F.col("digest").alias("__digest"), F.col("copies").alias("__copies"))
    copy = fresh(docs, "__copy")
    return (docs.join(plan, (F.xxhash64(docs["text"]) == plan["__digest"])
                      & docs["doc_id"].eqNullSafe(plan["__id"]) & docs["source"].eqNullSafe(plan["__source"]))
            .select(*[own(docs, c) for c in docs.columns],
                    F.explode(F.array_repeat(F.lit(0), plan["__copies"])).alias(copy))
            .drop(copy))


def op5_mix_sources(spark, sf_dir) -> DataFrame:
    return (mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"),
                    F.explode(F.expr("array_repeat(0, cast(rows as int))")).alias("__row"))
            .drop("__row"))


OP5_SQL = r"""
WITH RECURSIVE u AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR) || ':mix') AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM u GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM s),
w AS (SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS wt, source_size * 3.0::DOUBLE AS cap,
             (source_size * 3.0::DOUBLE) / ((rank - 1) % 3 + 1) AS ratio FROM r),
l AS (SELECT *, (CAST((SELECT sum(source_size) FROM s) AS DOUBLE)
        - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(wt) OVER () - coalesce(sum(wt) OVER (ORDER BY ratio, rank
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
f AS (SELECT ratio, rank, level FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
t AS (SELECT l.source, l.source_size, l.rank,
             CASE WHEN f.rank IS NULL OR l.ratio < f.ratio OR (l.ratio = f.ratio AND l.rank < f.rank)
                  THEN l.cap ELSE f.level * l.wt END AS target
      FROM l LEFT JOIN f ON true),
q AS (SELECT u.doc_id, u.size, t.source_size, t.target, t.rank,
             sum(u.size) OVER (PARTITION BY t.rank ORDER BY u.h, u.doc_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS queued
      FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, (e.i * CAST(source_size AS DOUBLE) + CAST(queued AS DOUBLE)) / target AS finish
      FROM q, (VALUES (0), (1), (2)) AS e(i) WHERE size > 0),
g AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rank
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM c),
k AS (SELECT doc_id, sum(size) AS taken FROM g
      WHERE upto <= (SELECT sum(source_size) FROM s) GROUP BY doc_id),
m AS (SELECT q.*, coalesce(k.taken, 0) AS cut FROM q LEFT JOIN k USING (doc_id)),
p AS (
  SELECT rank, CAST(floor(any_value(target) - sum(cut)) AS BIGINT) AS gap, NULL::STRUCT(a BIGINT, b VARCHAR, c BIGINT) AS last
  FROM m GROUP BY rank HAVING any_value(target) - sum(cut) > 0
  UNION ALL
  SELECT rank, gap - best.a AS gap, best AS last
  FROM (SELECT m.rank, any_value(p.gap) AS gap, max({'a': m.size, 'b': md5(m.doc_id || ':mix'), 'c': m.doc_id}) AS best
        FROM m JOIN p USING (rank)
        WHERE m.size > 0 AND m.cut < 3 * m.size AND m.size <= p.gap
          AND (p.last IS NULL OR {'a': m.size, 'b': md5(m.doc_id || ':mix'), 'c': m.doc_id} < p.last)
        GROUP BY m.rank)),
x AS (SELECT last.c AS doc_id FROM p WHERE last IS NOT NULL)
SELECT m.doc_id, m.size, m.source_size, m.target,
       CAST(m.cut + CASE WHEN x.doc_id IS NULL THEN 0 ELSE m.size END AS BIGINT) AS taken
FROM m LEFT JOIN x USING (doc_id)
"""
