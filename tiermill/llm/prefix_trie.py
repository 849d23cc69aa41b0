"""Prefix trie of conversations: double-array tries per prefix shard, shared upper nodes merged globally.

A conversation is a sequence of turns (role, text); every distinct sequence of
first d turns is a node. For each node: its members, children, leaves below,
saved tokens (what members after the first would repeat) and the members that
end there.

1. Places: turns are sorted by ranges of (conversation, turn), so a very long
   conversation spreads over tasks, and numbered; offsets of conversations that
   cross a task's border are one row a task.
2. Prefix keys: two 64-bit exclusive-or sums of hashes of (turn, depth) name
   every prefix, by running sums in blocks of ``BLOCK`` turns.
3. Equal conversations collapse into one class with a count, so a group of
   copies, however large, is one sequence.
4. Shards: the shallowest prefix of 1, 2, 4, 8 ... turns below which all classes
   have at most ``shard_turns`` turns together, or which one class has alone. A
   hot first turn is parted by longer prefixes. A class alone needs no trie:
   its nodes follow from its own turns.
5. In a shard's task the turns get dense ids, BASE and CHECK of a double array
   are packed over them, and walking it gives the shard's nodes.
6. Nodes above the shards are shared. Every shard sends one row for each of
   them (its totals); these are summed. What an upper node itself adds to those
   above it is given to the shard of its smallest member, summed along that
   shard's path, and summed again by node: no rounds by depth.

Rows without a conversation id belong to none. Null roles and texts count as
empty. Turns go by ``turn``, null first; equal ones by a hash of role and text,
so repeated rows are turns of their own beside each other. Very long texts are
only hashed and measured. Extra columns do not matter, and an empty table gives
an empty result (not even a root, which would have no smallest member).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.common import crc_of_id, sendable, shuffle_width
from tiermill.session import cut_lineage

#: Turns in a block of a conversation.
BLOCK = 1024
#: Conversation ids in one row of a list of members.
PIECE = 4096
#: Turns of all classes in a shard, at most (unless one class has more).
SHARD_TURNS = 100_000

NO_MEMBERS = hashlib.sha256(b"").hexdigest()


# -- turns in place ------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv, pos, k1, k2, size): every turn's place from 0, two hashes and the code points of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.xxhash64(role, text).alias("k1"),
        F.xxhash64(F.lit("second"), text, role).alias("k2"), F.char_length(text).cast("long").alias("size"))
    order = ["conv", "turn", "k1", "k2"]
    dealt = rows.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places within the task's rows of each conversation; rows come sorted."""
        last, seen = None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            new = np.concatenate([[conv[0] != last if last is not None else True], conv[1:] != conv[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
            pos = np.where(start < 0, seen + np.arange(len(conv)), np.arange(len(conv)) - start)
            last, seen = conv[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pos.astype(np.int64))], names=["conv", "k1", "k2", "size", "part", "pos"])

    numbered = dealt.select("conv", "k1", "k2", "size", F.spark_partition_id().alias("part")).mapInArrow(
        number, "conv long, k1 long, k2 long, size long, part int, pos long")
    numbered = cut_lineage(numbered)
    # conversations that go on in a later task, one a task at most
    ends = numbered.groupBy("part").agg(F.min("conv").alias("first"), F.max("conv").alias("last"))
    crossing = ends.withColumn("next", F.lead("first").over(Window.orderBy("part"))).where("last = next")
    counts = numbered.join(F.broadcast(crossing.select(F.col("last").alias("conv")).distinct()), "conv").groupBy("conv", "part").count()
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    return numbered.join(F.broadcast(offsets), ["conv", "part"], "left").select(
        "conv", (F.col("pos") + F.coalesce("offset", F.lit(0))).alias("pos"), "k1", "k2", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequences, conversations) after each takes its first turns from conversation c - c % 100.

    The first h = crc32(c) % 6 turns come from there (all if fewer, none if
    absent), the others are its own after its first h. Sequences: (conv, d, k1,
    k2, size, n), d from 1; conversations: (conv, n), also those without turns.
    """
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    own = own.withColumn("h", crc_of_id("conv") % 6).withColumn("source", F.col("conv") - F.col("conv") % 100)
    of_source = own.where("conv % 100 = 0").select(F.col("conv").alias("source"), F.col("own").alias("there"))
    info = own.join(of_source, "source", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    info = info.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    info = cut_lineage(info.select("conv", "source", "h", "taken", "n"))
    heads = turns.where("conv % 100 = 0 and pos < 5").withColumnRenamed("conv", "source")
    taken = info.where("taken > 0").join(heads, "source").where("pos < h").select(
        "conv", (F.col("pos") + 1).alias("d"), "k1", "k2", "size", "n")
    kept = turns.join(info, "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "k1", "k2", "size", "n")
    return taken.union(kept), info.select("conv", "n")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sequences, conversations) as they are."""
    n = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    return turns.join(n, "conv").select("conv", (F.col("pos") + 1).alias("d"), "k1", "k2", "size", "n"), n


# -- prefixes and classes --------------------------------------------------


def _step(which: int) -> Column:
    return F.xxhash64(F.lit(which), "k1", "k2", "d")


def _prefixes(sequences: DataFrame, block: int) -> DataFrame:
    """Adds p1, p2 (the prefix's key), q1, q2 (that of the one before) and upto (code points so far)."""
    rows = sequences.withColumns({"x1": _step(1), "x2": _step(2), "block": ((F.col("d") - 1) / block).cast("long")})
    sums = rows.where(F.col("n") > block).groupBy("conv", "block").agg(
        F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.sum("size").alias("bs"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv", "block", *[f(c).over(before).alias(c) for f, c in ((F.bit_xor, "b1"), (F.bit_xor, "b2"), (F.sum, "bs"))])
    upto = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"p1": F.bit_xor("x1").over(upto), "p2": F.bit_xor("x2").over(upto), "upto": F.sum("size").over(upto)})
    rows = rows.join(sendable(cut_lineage(sums)), ["conv", "block"], "left")
    zero = F.lit(0).cast("long")
    p1, p2 = (F.col(p).bitwiseXOR(F.coalesce(b, zero)) for p, b in (("p1", "b1"), ("p2", "b2")))
    return rows.select(
        "conv", "d", "n", "k1", "k2", "size", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("x1")).alias("q1"),
        p2.bitwiseXOR(F.col("x2")).alias("q2"), (F.col("upto") + F.coalesce("bs", zero)).alias("upto"))


def _classes(paths: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv, n, times, total, ends) of each distinct sequence: smallest conversation, turns, number, code points, digest of all ids."""
    zero = F.lit(0).cast("long")
    last = paths.where("d = n").select("conv", "n", "p1", "p2", "upto").union(
        conversations.where("n = 0").select("conv", "n", zero, zero, zero))
    key = ["p1", "p2", "n"]
    pieces = last.groupBy(*key, F.floor(F.col("conv") / PIECE).alias("piece")).agg(
        F.array_sort(F.collect_list("conv")).alias("ids"), F.min("upto").alias("upto"))
    pieces = cut_lineage(pieces.select(
        *key, "piece", "upto", F.size("ids").alias("times"), F.col("ids")[0].alias("conv"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("text")))
    classes = pieces.groupBy(*key).agg(
        F.min("conv").alias("conv"), F.sum("times").alias("times"), F.min("upto").alias("total"),
        F.count(F.lit(1)).alias("pieces"), F.when(F.count(F.lit(1)) == 1, F.sha2(F.min("text"), 256)).alias("ends"))
    classes = cut_lineage(classes)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by class and piece; a digest is carried from row to row."""
        now, sha, out = None, hashlib.sha256(), []
        for batch in batches:
            for *of, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if of != now:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = of, hashlib.sha256()
                    sha.update(text.encode())
                else:
                    sha.update(b"," + text.encode())
        if now is not None:
            out.append((*now, sha.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["p1", "p2", "n", "joined"])

    several = sendable(cut_lineage(classes.where("pieces > 1").select(*key)))
    joined = pieces.join(several, key, "left_semi").select(*key, "piece", "text").repartition("p1", "p2").sortWithinPartitions(*key, "piece")
    joined = joined.select(*key, "text").mapInArrow(digest, "p1 long, p2 long, n long, joined string")
    return cut_lineage(classes.join(sendable(cut_lineage(joined)), key, "left").select(
        "conv", "n", "times", "total", F.coalesce("ends", "joined").alias("ends")))


# -- the trie of a shard -----------------------------------------------------


def double_array(sequences: list[list[int]]) -> tuple[list[int], list[int]]:
    """BASE and CHECK over sequences of ids from 1 up.

    The child of state s by id c is state BASE[s] + c, and CHECK of it is s;
    unused states have CHECK -1. State 0 is the root. Children go to the first
    base at which all their states are free.
    """
    sequences = sorted(sequences)
    base, check = [1], [0]
    low = 1  # no free state below
    todo = [(0, 0, len(sequences), 0)]
    for state, a, b, depth in todo:  # grows while read: breadth first
        children: list[tuple[int, int, int]] = []
        for i in range(a, b):
            if len(sequences[i]) > depth:
                c = sequences[i][depth]
                if children and children[-1][0] == c:
                    children[-1] = (c, children[-1][1], i + 1)
                else:
                    children.append((c, i, i + 1))
        if not children:
            continue
        ids = [c for c, _, _ in children]
        while low < len(check) and check[low] >= 0:
            low += 1
        at = max(1, low - ids[0])
        size = len(check)
        while not all(at + c >= size or check[at + c] < 0 for c in ids):
            at += 1
        if at + ids[-1] >= size:
            more = at + ids[-1] + 1 - size
            base.extend([1] * more)
            check.extend([-1] * more)
        base[state] = at
        for c, x, y in children:
            check[at + c] = state
            todo.append((at + c, x, y, depth + 1))
    return base, check


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, q1 long, q2 long"


def nodes_of_shard(table: pa.Table) -> pa.Table:
    """The nodes of one shard, from its rows (conv, d, t, k1, k2, size, times, ends, q1, q2); the first is that of depth t."""
    column = {c: table.column(c).to_numpy() for c in ("conv", "d", "t", "k1", "k2", "size", "times", "q1", "q2")}
    order = np.lexsort((column["d"], column["conv"]))
    column = {c: v[order] for c, v in column.items()}
    ends = table.column("ends").take(pa.array(order)).to_pylist()
    t = int(column["t"][0])
    pairs = np.stack([column["k1"], column["k2"]], axis=1)
    below = column["d"] > t
    _, ids = np.unique(pairs[below], axis=0, return_inverse=True)
    code = np.zeros(len(below), np.int64)
    code[below] = ids.ravel() + 1  # dense ids of the shard's turns
    head = np.flatnonzero(~below)
    length = np.diff(np.append(head, len(below))) - 1
    base, check = (np.array(x) for x in double_array([code[h + 1 : h + 1 + n].tolist() for h, n in zip(head, length, strict=True)]))
    # walk all sequences together, one depth after the other
    state = np.zeros(len(below), np.int64)
    for step in range(1, int(length.max(initial=0)) + 1):
        rows = head[length >= step] + step
        state[rows] = base[state[rows - 1]] + code[rows]
    if (check[state[below]] != state[np.flatnonzero(below) - 1]).any():
        raise AssertionError("a walk left its path")
    n = len(check)
    members, depth, size = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.add.at(members, state, column["times"])
    np.minimum.at(smallest, state, column["conv"])
    depth[state], size[state] = column["d"], column["size"]
    used = np.flatnonzero(members > 0)
    inner = used[used > 0]
    children = np.bincount(check[inner], minlength=n)
    saved = (members - 1) * size
    leaves = (children == 0).astype(np.int64)
    for d in range(int(depth.max()), t, -1):
        at = inner[depth[inner] == d]
        np.add.at(saved, check[at], saved[at])
        np.add.at(leaves, check[at], leaves[at])
    digest = [NO_MEMBERS] * n
    for row in head + length:
        digest[state[row]] = ends[row]
    top = used == 0
    parent = pa.array(smallest[check[used]], pa.int64(), mask=top)
    outer = [pa.array(np.full(len(used), column[q][head[0]]), pa.int64(), mask=~top) for q in ("q1", "q2")]
    return pa.Table.from_arrays(
        [pa.array(smallest[used]), pa.array(depth[used]), parent, pa.array(members[used]), pa.array(children[used].astype(np.int64)),
         pa.array(leaves[used]), pa.array(saved[used]), pa.array([digest[i] for i in used], pa.string()), *outer],
        names=[c.split()[0] for c in NODE.split(", ")])


# -- all nodes -----------------------------------------------------------------


def nodes(sequences: DataFrame, conversations: DataFrame, shard_turns: int = SHARD_TURNS, block: int = BLOCK) -> DataFrame:
    """One row per node of the sequences (conv, d, k1, k2, size, n) of ``conversations`` (conv, n); see the module."""
    paths = cut_lineage(_prefixes(sequences, block))
    classes = _classes(paths, conversations)
    rows = paths.join(classes.select("conv", "times", "total", "ends"), "conv")
    rows = cut_lineage(rows.withColumn("ends", F.when(F.col("d") == F.col("n"), F.col("ends"))))

    # shards: (conv, t, members, shard) for classes that have one
    marks = rows.where(F.bit_count("d") == 1).select("conv", "d", "n", "p1", "p2")
    hot = marks.groupBy("p1", "p2", "d").agg(
        F.sum(F.col("n") - F.col("d") + 1).alias("turns"), F.count(F.lit(1)).alias("members")).where(
        f"members > 1 and turns > {int(shard_turns)}").select("p1", "p2", "d")
    fits = marks.join(sendable(cut_lineage(hot)), ["p1", "p2", "d"], "left_anti")
    placed = cut_lineage(fits.groupBy("conv").agg(F.min(F.struct("d", "p1", "p2")).alias("at")).select(
        "conv", F.col("at.d").alias("t"), F.col("at.p1").alias("s1"), F.col("at.p2").alias("s2")))
    of_shard = placed.groupBy("s1", "s2", "t").agg(F.min("conv").alias("shard"), F.count(F.lit(1)).alias("members"))
    placed = placed.join(of_shard, ["s1", "s2", "t"])
    rows = cut_lineage(rows.join(placed, "conv", "left").withColumns({
        "t": F.coalesce("t", F.col("n") + 1), "shard": F.coalesce("shard", "conv"), "members": F.coalesce("members", F.lit(0))}))

    # nodes inside the shards
    below = rows.where("d >= t")
    top = F.col("d") == F.col("t")
    alone = below.where("members = 1").select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.when(~top, F.col("conv")).alias("parent_conv_id"),
        F.col("times").alias("n_convs"), (F.col("d") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("times") - 1) * (F.col("total") - F.col("upto") + F.col("size"))).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"), F.when(top, F.col("q1")).alias("q1"), F.when(top, F.col("q2")).alias("q2"))
    tries = below.where("members > 1").select("s1", "s2", "t", "conv", "d", "k1", "k2", "size", "times", "ends", "q1", "q2").groupBy(
        "s1", "s2", "t").applyInArrow(nodes_of_shard, NODE)
    lower = cut_lineage(alone.union(tries))

    # nodes above: one row for each shard and node on the way to it
    tops = lower.where("q1 is not null")
    ending = classes.join(placed.select("conv"), "conv", "left_anti")
    zero = F.lit(0).cast("long")
    totals = tops.select(F.col("conv_id").alias("shard"), F.col("n_convs").alias("members"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")).union(
        ending.select("conv", "times", zero, zero))
    totals = cut_lineage(totals)
    way = rows.where("conv = shard and d < t").select("shard", "d", "p1", "p2", "q1", "q2", "size", "ends").join(totals, "shard")
    start = totals.join(classes.where("n = 0").select(F.col("conv").alias("shard"), "ends"), "shard", "left").select(
        "shard", zero.alias("d"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"),
        zero.alias("size"), "ends", "members", "leaves", "saved")
    way = cut_lineage(way.unionByName(start))
    node = ["p1", "p2", "d"]
    upper = way.groupBy(*node).agg(
        F.min("shard").alias("conv_id"), F.sum("members").alias("n_convs"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max("size").alias("size"), F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.max("ends").alias("ends"))
    upper = cut_lineage(upper)
    children = upper.where("d > 0").select("q1", "q2", "d").union(tops.select("q1", "q2", "depth")).groupBy(
        F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("d") - 1).alias("d")).agg(F.count(F.lit(1)).alias("n_children"))
    upper = cut_lineage(upper.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", zero)))
    # what an upper node adds to itself and to those above, along the way of its smallest member's shard
    adds = upper.select(F.col("conv_id").alias("shard"), "d", ((F.col("n_convs") - 1) * F.col("size")).alias("add_saved"),
                        (F.col("n_children") == 0).cast("long").alias("add_leaves"))
    deeper = Window.partitionBy("shard").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    sums = way.select("shard", *node).join(adds, ["shard", "d"], "left").select(
        *node, *[F.sum(F.coalesce(c, zero)).over(deeper).alias(c) for c in ("add_saved", "add_leaves")])
    sums = sums.groupBy(*node).agg(F.sum("add_saved").alias("add_saved"), F.sum("add_leaves").alias("add_leaves"))
    upper = cut_lineage(upper.join(sums, node).select(
        "conv_id", F.col("d").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("leaves") + F.col("add_leaves")).alias("n_leaves"), (F.col("saved") + F.col("add_saved")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_MEMBERS)).alias("ends_sha256"), "q1", "q2", "p1", "p2"))
    parents = sendable(cut_lineage(upper.select(
        F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))))
    every = lower.union(upper.drop("p1", "p2"))
    inside = every.where("q1 is null").drop("q1", "q2")
    top = every.where("q1 is not null").join(parents, ["q1", "q2", "depth"], "left").withColumn("parent_conv_id", F.col("above"))
    return inside.unionByName(top.select(*inside.columns))
