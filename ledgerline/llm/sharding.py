"""Sharding by balanced label propagation.

Documents linked to each other (here: with equal texts) should share a shard, and every shard
should hold the same number of rows, give or take one. Linked documents start scattered evenly
over the shards. In each round a group's documents move towards the shard that holds most of
their neighbours, within quotas per pair of shards: swaps (as many one way as the other) and
the free room of the receiving shard. So no shard ever passes its share, and the edges cut
between shards fall from round to round. Documents without a link fill the room left.

Where nearly all rows are linked, the flows between full shards need not match and propagation
stalls. Groups that are split although a shard could hold them are then taken out and placed
whole: in rounds, each asks a shard with room for it and is let in while the room lasts. Fewer
groups than shards are left when none finds room; for these, room is gathered in one shard by
swaps of whole small groups of other sizes (planned on counts per shard and size, at most
shards x ``SWAP_SIZES``). Only a group for which that fails is split over what room there is.

The members of a group are interchangeable, so a round works on (group, shard, count) rows, at
most one per shard for each group however many copies it has; a round is a join of those
counts with the group's target and the quotas. The table of flows between shards (shards
squared, a fixed bound) is the only thing the driver sees. Members get their shard at the end,
by their rank in the group; all ranks are taken in buckets, never in one window per group.

Cases: a null text counts as the empty one (size 16, crc 0); rows repeated in full are
documents of their own, linked by their equal texts; fewer rows than shards leave shards
empty; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import running_total, table, written

SHARDS = 40
ROUNDS = 12
PLACE_ROUNDS = 40
SWAP_SIZES = 64
ROWS_PER_BUCKET = 64
OVERHEAD = 16


def _buckets(n: int) -> int:
    return n // ROWS_PER_BUCKET + 1


def flow_quotas(flows: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Moves allowed from a to b: the swaps, then the receiver's free room in order of a."""
    flows = flows.copy()
    np.fill_diagonal(flows, 0)
    swaps = np.minimum(flows, flows.T)
    rest = flows - swaps
    before = np.cumsum(rest, axis=0) - rest
    return swaps + np.minimum(rest, np.maximum(free[None, :] - before, 0))


def propagate(groups: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(g, cnt, upto: running total of cnt) -> (g, shard, cnt) with every load within ``capacity``."""
    spark, k = groups.sparkSession, len(capacity)
    # scattered start: the j-th linked document of all goes to shard j mod k
    start = F.col("upto") - F.col("cnt")
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("cnt"), F.lit(k)) - 1)).alias("step")
    share = F.floor(F.col("cnt") / k) + F.when(F.col("step") < F.col("cnt") % k, 1).otherwise(0)
    state = written(groups.select("g", "cnt", start.alias("start"), step)
                    .select("g", F.pmod(F.col("start") + F.col("step"), F.lit(k)).cast("int").alias("shard"),
                            share.cast("long").alias("cnt")), "shard-state")
    load = np.zeros(k, dtype=np.int64)
    for a, c in state.groupBy("shard").agg(F.sum("cnt")).collect():  # one row per shard
        load[a] = c
    idle = 0
    for turn in range(rounds):
        free = np.maximum(np.asarray(capacity) - load, 0)
        room = F.element_at(F.array(*[F.lit(int(x)) for x in free]), F.col("shard") + 1)
        # odd turns: only towards shards with room, so that what a full shard holds up finds another
        open_ = room > 0 if turn % 2 else F.lit(True)
        pull = F.struct("cnt", F.xxhash64("g", "shard").alias("tie"), "shard", room.alias("room"))
        target = (state.groupBy("g").agg(F.max(F.when(open_, pull)).alias("t"), F.sum("cnt").alias("total"))
                  .where("t is not null").select(F.col("g").alias("__g"), "t", "total"))
        better = F.struct("cnt", F.xxhash64("g", "shard")) < F.struct("t.cnt", "t.tie")
        fits = F.col("total") - F.col("t.cnt") <= F.col("t.room")
        moves = (state.join(target, state["g"] == target["__g"], "left")
                 .select("g", "shard", "cnt", "total",
                         F.when(better | fits, F.col("t.shard")).otherwise(F.col("shard")).alias("to")))
        flow = np.zeros((k, k), dtype=np.int64)
        for a, b, c in moves.groupBy("shard", "to").agg(F.sum("cnt")).collect():  # at most k * k rows
            flow[a, b] += c
        quota = flow_quotas(flow, free)
        idle = 0 if quota.any() else idle + 1
        if idle == 2:
            break
        if not quota.any():
            continue
        load += quota.sum(axis=0) - quota.sum(axis=1)
        rows = [(int(a), int(b), int(quota[a, b])) for a, b in zip(*np.nonzero(quota))]
        allowed = F.broadcast(spark.createDataFrame(rows, "shard int, to int, quota long"))
        # small groups first: they can be brought together whole. Only rows that may move are lined up
        line = Window.partitionBy("shard", "to").orderBy("total", "g")
        first = line.rowsBetween(Window.unboundedPreceding, -1)
        gone = F.least(F.col("cnt"), F.greatest(F.col("quota") - F.coalesce(F.sum("cnt").over(first), F.lit(0)),
                                                F.lit(0))).cast("long")
        asked = moves.join(allowed, ["shard", "to"], "left")
        moved = asked.where("quota is not null").withColumn("gone", gone)
        parts = F.array(F.struct(F.col("shard"), (F.col("cnt") - F.col("gone")).alias("cnt")),
                        F.struct(F.col("to").alias("shard"), F.col("gone").alias("cnt")))
        state = written(moved.select("g", F.inline(parts)).where("cnt > 0")
                        .unionByName(asked.where("quota is null").select("g", "shard", "cnt"))
                        .groupBy("g", "shard").agg(F.sum("cnt").alias("cnt")), "shard-state")
    return state


def gather(room: list[int], counts: dict[tuple[int, int], int], sizes: list[int]) -> tuple[list[int | None], dict]:
    """Shards for whole groups of ``sizes`` that fit no shard's ``room``. ``counts`` says how many
    whole groups of each (shard, size) there are to move. Returns the shards (None: no way) and the
    moves {(shard, size, other shard): groups}. Room goes to the shard that has most, by swaps
    of a group there with a smaller one, or none, of a shard that has room for the difference."""
    room, counts, moves, out = list(room), dict(counts), Counter(), []

    def move(a: int, b: int, u: int) -> None:
        if not u:
            return
        if moves[b, u, a]:   # rather undo a move than make another
            moves[b, u, a] -= 1
        else:
            moves[a, u, b] += 1
        counts[a, u] -= 1
        counts[b, u] = counts.get((b, u), 0) + 1
        room[a] += u
        room[b] -= u

    for z in sorted(sizes, reverse=True):
        for a in sorted(range(len(room)), key=lambda s: -room[s]):
            tried = True
            while room[a] < z and tried:
                tried = False
                for b in sorted(range(len(room)), key=lambda s: -room[s]):
                    most = min(room[b], z - room[a])
                    if b == a or most <= 0:
                        continue
                    here = [u for u in range(1, SWAP_SIZES + 1) if counts.get((a, u), 0) > 0]
                    there = [0] + [v for v in range(1, SWAP_SIZES + 1) if counts.get((b, v), 0) > 0]
                    best = max(((u - v, -u, u, v) for u in here for v in there if 0 < u - v <= most), default=None)
                    if best:
                        move(a, b, best[2])
                        move(b, a, best[3])
                        tried = True
                        break
            if room[a] >= z:
                break
        fits = next((s for s in range(len(room)) if room[s] >= z), None)
        out.append(fits)
        if fits is not None:
            room[fits] -= z
    return out, {k: n for k, n in moves.items() if n}


def reunite(state: DataFrame, capacity: list[int]) -> DataFrame:
    """``state`` with the split groups that a shard could hold placed whole (see above)."""
    spark, k = state.sparkSession, len(capacity)
    totals = state.groupBy("g").agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("parts"))
    homeless = written(totals.where((F.col("parts") > 1) & (F.col("total") <= max(capacity))).select("g", "total"), "shard-homeless")
    left = homeless.count()
    if not left:
        return state
    settled = written(state.join(homeless.select("g"), "g", "left_anti"), "shard-settled")
    room = np.asarray(capacity)
    for s, c in settled.groupBy("shard").agg(F.sum("cnt")).collect():  # one row per shard
        room[s] -= c
    parts = [settled]
    for turn in range(PLACE_ROUNDS):
        rooms = F.array(*[F.struct(F.lit(int(r)).alias("r"), F.lit(s).alias("s")) for s, r in enumerate(room)])
        open_ = F.filter(rooms, lambda x: x["r"] >= F.col("total"))
        ask = homeless.withColumn("open", open_).withColumn(
            "to", F.get("open", F.pmod(F.xxhash64("g", F.lit(turn)), F.greatest(F.size("open"), F.lit(1))).cast("int"))["s"])
        ask = ask.where("to is not null").drop("open")
        spread = F.pmod(F.xxhash64("g", F.lit(turn), F.lit(1)), F.lit(2 ** 40))
        lined = running_total(ask, ["to"], ["total", "g"], "total", "upto", spread, _buckets(left // k))
        has = F.element_at(F.array(*[F.lit(int(r)) for r in room]), F.col("to") + 1)
        let_in = written(lined.where(F.col("upto") <= has).select("g", F.col("to").alias("shard"), F.col("total").alias("cnt")),
                         "shard-placed-whole")
        taken = {s: (c, n) for s, c, n in let_in.groupBy("shard").agg(F.sum("cnt"), F.count(F.lit(1))).collect()}
        if not taken and ask.isEmpty():
            break
        for s, (c, n) in taken.items():
            room[s] -= c
            left -= n
        parts.append(let_in)
        homeless = written(homeless.join(let_in.select("g"), "g", "left_anti"), "shard-homeless")
        if not left:
            break
    if 0 < left <= 4 * k:  # as many groups as are counted, a small list
        rows = sorted(homeless.collect(), key=lambda r: (-r["total"], r["g"]))
        whole = written(reduce(DataFrame.unionByName, parts).join(
            totals.where("parts = 1").select("g").unionByName(reduce(DataFrame.unionByName, parts[1:], settled.limit(0)).select("g")),
            "g", "left_semi"), "shard-whole")
        small_ = whole.where(F.col("cnt") <= SWAP_SIZES)
        counts = {(s, c): n for s, c, n in small_.groupBy("shard", "cnt").agg(F.count(F.lit(1))).collect()}
        at, moves = gather(room.tolist(), counts, [r["total"] for r in rows])
        settled = reduce(DataFrame.unionByName, parts)
        if moves:
            turn_ = Counter()
            orders = []
            for (a, u, b), n in sorted(moves.items()):
                orders += [(a, u, turn_[a, u] + i + 1, b) for i in range(n)]
                turn_[a, u] += n
            plan = F.broadcast(spark.createDataFrame(orders, "shard int, cnt long, place int, to int"))
            place = F.row_number().over(Window.partitionBy("shard", "cnt").orderBy("g"))
            picked = written(small_.withColumn("place", place).where(F.col("place") <= max(turn_.values()))
                             .join(plan, ["shard", "cnt", "place"]).select("g", F.col("to").alias("shard"), "cnt"), "shard-swapped")
            settled = settled.join(picked.select("g"), "g", "left_anti").unionByName(picked)
            for (a, u, b), n in moves.items():
                room[a] += u * n
                room[b] -= u * n
        own = [(r["g"], s, r["total"]) for r, s in zip(rows, at) if s is not None]
        for _, s, c in own:
            room[s] -= c
        if own:
            settled = settled.unionByName(spark.createDataFrame(own, settled.schema))
        homeless = homeless.join(F.broadcast(spark.createDataFrame([(g,) for g, _, _ in own] or [("",)], "g string")), "g", "left_anti")
        parts = [settled]
    # what is left is laid along the room that is left
    ends = np.cumsum(room)
    spread = F.pmod(F.xxhash64("g"), F.lit(2 ** 40))
    lined = running_total(homeless.withColumn("__one", F.lit(0)), ["__one"], ["g"], "total", "upto", spread, _buckets(left))
    line = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(int(e - r)).alias("lo"), F.lit(int(e)).alias("hi"))
                     for s, (r, e) in enumerate(zip(room, ends))])
    pieces = F.filter(F.transform(line, lambda x: F.struct(
        x["shard"].alias("shard"), (F.least(x["hi"], F.col("upto")) - F.greatest(x["lo"], F.col("upto") - F.col("total"))).alias("cnt"))),
        lambda x: x["cnt"] > 0)
    parts.append(lined.select("g", F.inline(pieces)))
    return written(reduce(DataFrame.unionByName, [p.select("g", F.col("shard").cast("int").alias("shard"),
                                                           F.col("cnt").cast("long").alias("cnt")) for p in parts]), "shard-state")


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``."""
    text = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = written(docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                               F.crc32(text).alias("text_crc32"), F.md5(text).alias("g")), "shard-rows")
    counts = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("cnt")), "shard-groups")
    n, linked, groups = counts.agg(F.coalesce(F.sum("cnt"), F.lit(0)),
                                   F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)),
                                   F.count(F.when(F.col("cnt") > 1, 1))).first()
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    spread = F.pmod(F.xxhash64("g"), F.lit(2 ** 40))
    ranges = propagate(running_total(counts.where("cnt > 1").withColumn("__one", F.lit(0)), ["__one"], ["g"],
                                     "cnt", "upto", spread, _buckets(groups)).drop("__one"),
                       capacity, rounds)
    ranges = reunite(ranges, capacity)
    load = {s: c for s, c in ranges.groupBy("shard").agg(F.sum("cnt")).collect()}  # one row per shard

    # members: rank in their group -> the group's shards in order. Groups above a thousandth of
    # all rows, at most 1000 of them, meet their documents by broadcast; the rest by shuffle
    bounds = written(ranges.withColumn("hi", F.sum("cnt").over(Window.partitionBy("g").orderBy("shard")))
                     .groupBy("g").agg(F.sort_array(F.collect_list(F.struct("hi", "shard"))).alias("bounds"))
                     .join(counts.where("cnt > 1"), "g").withColumnRenamed("g", "__g"), "shard-bounds")
    is_hot = F.col("cnt") > max(ROWS_PER_BUCKET, n // 1000)
    hot, cold = F.broadcast(bounds.where(is_hot)), bounds.where(~is_hot)
    part = F.pmod(F.xxhash64("doc_id", "size", F.lit(7)), F.lit(2 ** 40))
    same = F.col("g") == F.col("__g")
    j = (rows.join(hot, same).unionByName(
        rows.join(hot.select("__g"), same, "left_anti").join(cold, same, "left")).drop("__g"))
    # only groups too large for one window are ranked in several buckets
    inside = F.when(F.col("cnt") > ROWS_PER_BUCKET,
                    F.pmod(part, F.floor(F.col("cnt") / ROWS_PER_BUCKET) + 1)).otherwise(F.lit(0))
    members = running_total(j.where("bounds is not null").withColumn("one", F.lit(1)), ["g"], ["doc_id"],
                            "one", "rank", inside, _buckets(n) + 1)
    members = members.select(
        "doc_id", "size", "text_crc32",
        F.element_at(F.filter("bounds", lambda b: b["hi"] >= F.col("rank")), 1)["shard"].alias("shard"))

    # documents without a link: rank among them -> the room left
    free = np.cumsum([capacity[s] - load.get(s, 0) for s in range(shards)]).tolist()
    singles = running_total(j.where("bounds is null").withColumn("one", F.lit(1)).withColumn("__all", F.lit(0)),
                            ["__all"], ["g"], "one", "rank", part, _buckets(n - linked))
    room = F.array(*[F.lit(int(x)) for x in free])
    singles = singles.select("doc_id", "size", "text_crc32",
                             F.size(F.filter(room, lambda x: x < F.col("rank"))).alias("shard"))

    placed = written(members.unionByName(singles).withColumn("shard", F.col("shard").cast("int")), "shard-placed")
    return running_total(placed.withColumn("one", F.lit(1)), ["shard"], ["doc_id", "text_crc32"], "one", "slot", part,
                         _buckets(n // shards)).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") - 1).cast("long").alias("slot"))


def op10_shard(spark, sf_dir) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
