"""Benchmark decontamination by SimHash windows of the size of the items.

A document is contaminated by a benchmark item if one of its windows of as many words as the
item has a weighted (multiset) Jaccard similarity of at least ``SIMILARITY`` on shingles of
``SHINGLE`` words. A document of fewer words than the item has one window, all its words. Words are
runs of letters and digits, lower-cased.

1. Windows. A similar window shares at least 2s/(1+s) of the item's shingles (a window of fewer
   shingles: s/(1+s) of both together). A join of all
   shingles of all documents with the benchmark's, and a count per document, item and range of
   positions, leaves exactly the starts of windows that can still reach that; every other
   window's similarity is below the threshold, so nothing is lost.
2. Fingerprints. Each of these windows and each item gets a 64-bit SimHash of its shingles.
3. Multi-index Hamming blocks. The 64 bits are cut into 12 blocks. Two fingerprints within
   ``RADIUS`` = 23 bits differ by at most one bit in some block, so items are indexed under
   every block's value and its one-bit neighbours, and windows for the item's length look up
   their 12 values: all pairs within the radius are found.
4. The exact similarity of each pair found decides.

The radius is wide for the similarity: at 0.8 two fingerprints differ in 10 bits on average
(angle 27 degrees of 180, over 64), with a standard deviation of 3.

DataFrame functions only. The benchmark's shingles are broadcast while they are at most
``BROADCAST_ROWS``, beyond that they are joined by shuffle. The texts themselves move only
once, to meet the windows found.

Cases: an item of fewer words than a shingle is one shingle of all its words; an item without
words matches nothing, nor does a text of fewer words than a shingle of the item (null and empty
texts among them); rows equal in doc_id and text are one document; repeated items count once; empty
tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import table, written

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS = (6, 6, 6, 6, 5, 5, 5, 5, 5, 5, 5, 5)  # bits
RADIUS = 2 * len(BLOCKS) - 1
BROADCAST_ROWS = 500_000
WINDOWS_PER_TASK = 2000


def words_of(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


def shingles(words: Column, k: int) -> Column:
    """Hashes of all runs of ``k`` words."""
    last = F.size(words) - k
    return F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))).otherwise(
        F.array().cast("array<bigint>"))


# For 4 bits of a hash: one 16-bit counter lane per bit.
LANES = [sum((v >> j & 1) << 16 * j for j in range(4)) for v in range(16)]


def simhash(hashes: Column) -> Column:
    """Bit b is set if over half of the hashes have it. Four bits are counted at a time, in
    16-bit lanes of a long; more hashes than a lane can count are counted bit by bit."""
    n = F.size(hashes)
    zero = F.lit(0).cast("long")

    def lane_sums(k):
        return F.aggregate(hashes, zero, lambda acc, h: acc + F.element_at(
            F.array(*[F.lit(x).cast("long") for x in LANES]),
            (F.call_function("shiftrightunsigned", h, k * 4).bitwiseAND(F.lit(15)) + 1).cast("int")))

    def with_bit(acc, b, ones):
        return F.when(ones * 2 > n, acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(acc)

    def of_lanes(lanes):
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, lambda acc, b: with_bit(
            acc, b, F.call_function("shiftrightunsigned", F.get(lanes, F.call_function("shiftright", b, F.lit(2))), b % 4 * 16)
            .bitwiseAND(F.lit(65535))))

    def of_bits():
        return F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, lambda acc, b: with_bit(acc, b, F.size(
            F.filter(hashes, lambda h: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)) == 1))))
    lanes = F.transform(F.sequence(F.lit(0), F.lit(15)), lane_sums)
    fast = F.get(F.transform(F.array(lanes), of_lanes), F.lit(0))  # the lanes are summed once
    return F.when(n <= 32767, fast).otherwise(of_bits())


def occurrences(hashes: Column) -> Column:
    """The multiset as a set: the first of equal hashes as it is, the n-th hashed with n."""
    repeated = F.transform(hashes, lambda h, i: _nth(h, F.size(F.filter(F.slice(hashes, F.lit(1), i), lambda x: x == h))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), hashes).otherwise(repeated)


def _nth(h: Column, n: Column) -> Column:
    return F.when(n == 0, h).otherwise(F.xxhash64(h, n))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, bits) of each block."""
    return [(sum(BLOCKS[:i]), n) for i, n in enumerate(BLOCKS)]


def block_values(fp: Column, neighbours: bool) -> Column:
    """Array of (block, value); with all one-bit neighbours of the values if asked for."""
    out = []
    for i, (at, n) in enumerate(_blocks()):
        value = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1))
        flips = [0, *[1 << b for b in range(n)]] if neighbours else [0]
        out += [F.struct(F.lit(i).alias("block"), value.bitwiseXOR(F.lit(x)).cast("int").alias("value")) for x in flips]
    return F.array(*out)


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """(item, item_id, len, k, m, hs, fp) of the distinct items with words; m shingles hs of k words."""
    b = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    b = b.withColumn("len", F.size("w"))
    parts = [b.where(F.col("len") >= k).select("*", F.lit(k).alias("k"), shingles(F.col("w"), k).alias("hs"))]
    parts += [b.where(F.col("len") == n).select("*", F.lit(n).alias("k"), shingles(F.col("w"), n).alias("hs"))
              for n in range(1, k)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.xxhash64("item_id", "w").alias("item"), "item_id", "len", "k", F.size("hs").alias("m"), "hs",
                      simhash(F.col("hs")).alias("fp"))


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest, item_id, start, words, distance, similarity): the best window of every
    contaminated document for every item it holds (ties: the first)."""
    items = written(_items(benchmark, k), "decontam-items")
    sizes = {r["k"]: r["n"] for r in items.groupBy("k").agg(F.sum("m").alias("n")).collect()}  # k rows at most
    share = 2 * similarity / (1 + similarity)
    # a window of m shingles must share at least `need` of them
    rare = items.select("item", "len", "m", F.ceil(F.col("m") * F.lit(share) - F.lit(1e-9)).cast("int").alias("need"),
                        "k", F.explode(F.array_distinct("hs")).alias("h"))
    d = docs.select("doc_id", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("w"))
    anchors = None
    for size, n in sorted(sizes.items()):
        known = rare.where(F.col("k") == size).drop("k")
        known = F.broadcast(known) if n <= BROADCAST_ROWS else known
        a = (d.select("doc_id", "digest", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"), size)).alias("pos", "h"))
             .join(known, "h").drop("h"))
        anchors = a if anchors is None else anchors.unionByName(a)
    if anchors is None:  # no item has a word
        return docs.sparkSession.createDataFrame([], "doc_id long, digest long, item_id long, start int, words int, "
                                                     "distance int, similarity double")
    # a document of fewer words than the item is one window, of so many shingles less
    missing = F.greatest(F.col("len") - F.col("n"), F.lit(0))
    anchors = anchors.withColumn("need", F.when(missing > 0, F.ceil(
        (2 * F.col("m") - missing) * F.lit(share / 2) - F.lit(1e-9)).cast("int")).otherwise(F.col("need")))
    # per document and item: the anchors that are the first of `need` within a window's length,
    # and all starts of windows that hold such a run
    pos, need = F.col("pos"), F.col("need")
    firsts = F.filter(pos, lambda p, i: F.get(pos, i + need - 1) - p <= F.col("m") - 1)
    starts = F.array_distinct(F.flatten(F.transform(
        firsts, lambda p: F.sequence(F.greatest(p - (F.col("m") - need), F.lit(0)), p))))
    runs = (anchors.groupBy("doc_id", "digest", "item", "len", "m", "need", "n")
            .agg(F.sort_array(F.collect_set("pos")).alias("pos"))
            .where(F.size("pos") >= need)
            .select("doc_id", "digest", "len", F.filter(starts, lambda s: (s == 0) | (s + F.col("len") <= F.col("n"))).alias("starts")))
    wanted = (runs.select("doc_id", "digest", F.explode("starts").alias("start"), "len")
              .groupBy("doc_id", "digest").agg(F.collect_set(F.struct("len", "start")).alias("wanted")))
    wanted = written(wanted, "decontam-windows").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"),
                                                        "wanted")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    held = (texts.join(wanted, (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__id")))
            .select("doc_id", "digest", "wanted", words_of(F.col("text")).alias("w")).distinct())
    windows = None
    for size in sorted(sizes):
        of_size = F.filter("wanted", (lambda x: x["len"] >= size) if size == k else (lambda x: x["len"] == size))
        hs = held.select("doc_id", "digest", of_size.alias("wanted"), shingles(F.col("w"), size).alias("all"))
        cut = (hs.select("doc_id", "digest", "all", F.explode("wanted").alias("at"))
               .select("doc_id", "digest", F.col("at.start").alias("start"), F.col("at.len").alias("len"),
                       F.slice("all", F.col("at.start") + 1, F.col("at.len") - size + 1).alias("hs")))
        windows = cut if windows is None else windows.unionByName(cut)
    # few rows with much work each: dealt out evenly, not gathered by their size in bytes
    windows = written(windows, "decontam-shingles")
    windows = written(windows.repartition(max(1, windows.count() // WINDOWS_PER_TASK))
                      .select("doc_id", "digest", "start", "len", simhash(F.col("hs")).alias("fp"),
                              occurrences(F.col("hs")).alias("hs")), "decontam-fingerprints")

    index = (items.select("item", "item_id", F.col("len").alias("__len"), "m", F.col("fp").alias("item_fp"),
                          occurrences(F.col("hs")).alias("item_hs"), F.inline(block_values(F.col("fp"), True)))
             .withColumnsRenamed({"block": "__block", "value": "__value"}))
    looked = windows.select("*", F.inline(block_values(F.col("fp"), False)))
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    # a pair may meet in several blocks: it counts in the first
    masks = F.array(*[F.lit(((1 << n) - 1) << at).cast("long") if at + n < 64 else F.lit(-(1 << at)) for at, n in _blocks()])
    met_before = F.exists(F.slice(masks, 1, F.col("block")), lambda x: F.bit_count(differ.bitwiseAND(x)) <= 1)
    pairs = looked.join(index, (F.col("len") == F.col("__len")) & (F.col("block") == F.col("__block"))
                        & (F.col("value") == F.col("__value"))).where(
        (F.bit_count(differ) <= RADIUS) & ~met_before)
    both, held = F.size(F.array_intersect("hs", "item_hs")), F.size("hs")
    found = (pairs.select("doc_id", "digest", "item_id", "start", (F.col("len") - F.col("m") + held).alias("words"),
                          F.bit_count(differ).alias("distance"), both.alias("both"), (F.col("m") + held).alias("m"))
             .withColumn("similarity", F.col("both") / (F.col("m") - F.col("both")))
             .where(F.col("similarity") >= similarity))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "words", "distance")).alias("b")
    return found.groupBy("doc_id", "digest", "item_id").agg(best).select(
        "doc_id", "digest", "item_id", (-F.col("b.back")).alias("start"), F.col("b.words").alias("words"),
        F.col("b.distance").alias("distance"), F.col("b.similarity").alias("similarity"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = contaminated(docs, benchmark, **options).select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    return docs.join(bad, (F.xxhash64(docs["text"]) == bad["__digest"])
                     & docs["doc_id"].eqNullSafe(bad["__id"]), "left_anti")


def op9_decontaminate(spark, sf_dir) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")
