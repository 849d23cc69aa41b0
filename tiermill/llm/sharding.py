"""Sharding by balanced label propagation under capacity quotas.

Documents are linked when they are members of one group (of equal texts, or
whatever table of members is given). They start in shards dealt by a hash. In
each round, a document's score for a shard is the number of its neighbours
there, by a join of the members with each group's count by shard; it asks to
move to the shard with the highest score among its own and those that are
open. Wishes are granted as swaps and rings of shards (as many come as go),
then as far as a shard has room, groups one after the other (the room counts
linked documents only, as unlinked ones can give way), then against groups
that lie in the wanted shard as a whole and lose nothing elsewhere. So no shard
is filled with more linked documents than its quota. Shards with room are open;
when few move on, also those that took a tenth of the askers of the last such
round. Rounds end when nobody moved in three. Ties go by a hash of group and
shard, so that all members of a group agree on one.

At last the unlinked documents even out the shards: every shard gets exactly
its quota, so counts differ by one at most (the law ``rows``). A shard's
surplus, unlinked documents first, fills the others' gaps by position.

A group's counts are one row of as many numbers as there are shards, summed
before the shuffle, so a group with a third of all documents is one row where
it matters. Only numbers by shard and pair of shards come to the driver.

Null texts count as empty for the link and have size 8. Repeated rows are
documents of their own; ties in the id do not matter, nor do extra columns.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import with_key
from tiermill.session import cut_lineage
#: Whole groups give way by so many hash buckets of a shard.
_BUCKETS = 64


def quotas(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _of_shard(shard: Column, values: Sequence[int]) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (shard + 1).cast("int"))


def propagate(members: DataFrame, room: Sequence[int], shards: int, rounds: int = 16, seed: int = 3) -> DataFrame:
    """(key, shard) of the linked documents in ``members`` (key, group).

    ``room``: the most linked documents a shard may hold.
    """
    spark = members.sparkSession
    at = cut_lineage(
        members.select("key").distinct().withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(shards)).cast("int"))
    )
    members = members.select("key", "group")
    takes = [True] * shards  # shards that took enough of those who asked
    swap, idle = False, 0
    for _ in range(rounds):
        held = {r["shard"]: r["count"] for r in at.groupBy("shard").count().collect()}
        free = [max(0, room[s] - held.get(s, 0)) for s in range(shards)]
        open_ = [swap and takes[s] or free[s] >= max(1, room[s] // 200) for s in range(shards)]
        here = members.join(at, "key")
        count = [F.sum((F.col("shard") == s).cast("double")) for s in range(shards)]
        tie = [(F.pmod(F.xxhash64("group", F.lit(s)), F.lit(997)) + 1) / 1e5 for s in range(shards)]
        near = here.groupBy("group").agg(*[c.alias(f"c{s}") for s, c in enumerate(count)]).select(
            "group", F.array(*[F.col(f"c{s}") + F.when(F.col(f"c{s}") > 0, tie[s]).otherwise(0.0) for s in range(shards)]).alias("near"))
        score = here.join(near, "group").groupBy("key", "shard").agg(
            F.min(F.xxhash64("group")).alias("first"), *[F.sum(F.col("near")[s]).alias(f"n{s}") for s in range(shards)])
        whole = F.lit(True)
        for s in range(shards):
            whole = whole & ((F.col("shard") == s) | (F.col(f"n{s}") == 0))
        best = F.greatest(*[
            F.struct(F.when((F.col("shard") == s) | F.lit(open_[s]), F.col(f"n{s}")).otherwise(-1.0).alias("n"), F.lit(s).alias("s"))
            for s in range(shards)
        ])
        bucket = F.pmod(F.xxhash64("first", F.lit(seed)), F.lit(_BUCKETS)).cast("int")
        asked = cut_lineage(score.select("key", "shard", best["s"].alias("to"), "first", whole.alias("whole"), bucket.alias("b")))
        wish = [[0] * shards for _ in range(shards)]
        for r in asked.where("`to` <> shard").groupBy("shard", "to").count().collect():
            wish[r["shard"]][r["to"]] = r["count"]
        granted = exchange(wish, free)
        away: list[tuple[int, int, int]] = []  # (shard, bucket, to) of the groups that give way
        if any(any(row) for row in wish) and granted != wish:
            rows = asked.where("whole").groupBy("shard", "b").count().collect()
            away = give_way(wish, granted, [(r["count"], r["shard"], r["b"]) for r in rows])
        came, wanted = [sum(c) for c in zip(*granted, strict=True)], [sum(c) for c in zip(*wish, strict=True)]
        if swap:
            takes = [wanted[s] <= 10 * came[s] for s in range(shards)]
        idle = 0 if any(came) else idle + 1
        if idle == 3 or not any(wanted) and all(open_):
            break
        if sum(came) < 0.02 * sum(held.values()):
            swap = not swap
        if not any(came):
            continue
        pair = (F.col("shard") * shards + F.col("to")).alias("pair")
        # in a pair of shards groups come one after the other
        movers = number_within(
            asked.where("`to` <> shard").select("key", "shard", "to", pair, F.xxhash64("first", "to").alias("first")), "pair", ["first", "key"])
        moves = F.col("slot") < _of_shard(F.col("pair"), [n for row in granted for n in row])
        rest = asked.where("`to` = shard").select("key", "shard", "whole", "b")
        if away:
            moved = F.broadcast(spark.createDataFrame(away, "shard int, b int, aside int").withColumn("whole", F.lit(True)))
            rest = rest.join(moved, ["shard", "b", "whole"], "left").select("key", F.coalesce("aside", "shard").alias("shard"))
        at = cut_lineage(rest.select("key", "shard").unionByName(
            movers.select("key", F.when(moves, F.col("to")).otherwise(F.col("shard")).alias("shard"))))
    return at


def exchange(wish: Sequence[Sequence[int]], free: Sequence[int]) -> list[list[int]]:
    """How many of the ``wish[s][t]`` documents of shard s that ask for t may move.

    Swaps, then rings of more shards, then moves into free room; a shard gains
    no more than it has ``free``.
    """
    shards = len(wish)
    left, free = [list(row) for row in wish], list(free)
    granted = [[0] * shards for _ in range(shards)]

    def grant(way: list[tuple[int, int]], n: int) -> None:
        for s, t in way:
            left[s][t] -= n
            granted[s][t] += n

    for s in range(shards):
        for t in range(s):
            grant([(s, t), (t, s)], min(left[s][t], left[t][s]))
    for s in range(shards):
        while way := _ring(left, s):
            grant(way, min(left[a][b] for a, b in way))
    again = True
    while again:
        again = False
        for s in range(shards):
            for t in range(shards):
                if n := min(left[s][t], free[t]):
                    grant([(s, t)], n)
                    free[s], free[t], again = free[s] + n, free[t] - n, True
    return granted


def give_way(wish: Sequence[Sequence[int]], granted: list[list[int]], whole: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(shard, bucket, to) of whole groups that change places with documents not yet granted.

    ``whole``: (documents, shard, bucket) of the groups that lie in one shard;
    ``granted`` grows by as many as give way.
    """
    left = [[w - g for w, g in zip(*rows, strict=True)] for rows in zip(wish, granted, strict=True)]
    away = []
    for n, t, b in sorted(whole, key=lambda r: (-r[0], r[1:])):
        s = max(range(len(left)), key=lambda s: left[s][t])
        if n <= left[s][t]:
            left[s][t] -= n
            granted[s][t] += n
            away.append((t, b, s))
    return away


def _ring(left: list[list[int]], start: int) -> list[tuple[int, int]]:
    """The moves of a shortest ring of wishes through ``start`` (none: empty)."""
    came: dict[int, int] = {}
    todo = deque([start])
    while todo and start not in came:
        s = todo.popleft()
        for t, n in enumerate(left[s]):
            if n and t not in came:
                came[t] = s
                todo.append(t)
    if start not in came:
        return []
    way = [(came[start], start)]
    while way[-1][0] != start:
        way.append((came[way[-1][0]], way[-1][0]))
    return way


def number_within(rows: DataFrame, part: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``slot``: the place from 0 inside each ``part``, by ``order``.

    A range sort, so a part with many rows spreads over tasks. The table of
    offsets has a row for each task and part that meet, at most tasks plus
    parts, and only it goes to all tasks.
    """
    spread = rows.repartitionByRange(part, *order).sortWithinPartitions(part, *order)
    marked = cut_lineage(spread.withColumn("_m", F.monotonically_increasing_id()))
    marked = marked.withColumn("_task", F.shiftright("_m", 33)).withColumn("_row", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    runs = marked.groupBy(part, "_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(part).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(part, "_task", (before - F.col("_first")).alias("_shift"))
    return marked.join(F.broadcast(runs), [part, "_task"]).withColumn("slot", F.col("_row") + F.col("_shift")).drop("_m", "_task", "_row", "_shift")


def shard_by_rows(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard) of every row; equal texts are linked."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = cut_lineage(with_key(docs, id_col, text_col).select(
        "key", "id", (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("group"),
    ))
    total = base.count()
    quota = quotas(total, shards)
    groups = base.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("group")
    members = cut_lineage(base.join(groups, "group").select("key", "group"))
    linked = propagate(members, quota, shards)
    placed = base.join(linked.withColumnRenamed("shard", "now"), "key", "left").select(
        "key", "id", "size", "text_crc32", "group", F.isnull("now").alias("loose"),
        F.coalesce("now", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(shards)).cast("int")).alias("now"),
    )
    placed = number_within(placed, "now", ["loose", "group", "key"])
    held = {r["now"]: r["n"] for r in placed.groupBy("now").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = [held.get(s, 0) for s in range(shards)]
    over, gap = [max(0, h - q) for h, q in zip(held, quota, strict=True)], [max(0, q - h) for h, q in zip(held, quota, strict=True)]
    over_before, gap_before = [0, *accumulate(over)], [0, *accumulate(gap)]
    nth = F.col("slot") - _of_shard(F.col("now"), quota) + _of_shard(F.col("now"), over_before[:-1])
    stays = F.col("slot") < _of_shard(F.col("now"), quota)
    to, place = F.lit(None).cast("int"), F.lit(None).cast("long")
    for s in range(shards):
        if gap[s]:
            here = (nth >= gap_before[s]) & (nth < gap_before[s + 1])
            to, place = F.when(here, F.lit(s)).otherwise(to), F.when(here, nth - gap_before[s] + held[s]).otherwise(place)
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        F.when(stays, F.col("now")).otherwise(to).cast("int").alias("shard"),
        F.when(stays, F.col("slot")).otherwise(place).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
