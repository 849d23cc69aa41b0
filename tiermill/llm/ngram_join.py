"""N-gram Jaccard join in the metric space of Jaccard distances: pivots, windows, one further exact join.

A document is the set of its word n-grams; two link when 100 times their
shared n-grams reach ``percent`` times their union, that is at a Jaccard
distance of at most r. Equal sets are collapsed first.

Unrelated documents are all at distance 1 from any pivot, so cells around
freely chosen pivots would not part them. Pivots are therefore reached by
content: documents within r must share one of the first few n-grams of an
order common to all (the prefix), so every prefix n-gram held by two sets
makes a region, whose pivot is its smallest member. The order goes by the
binary logarithm of the frequency of the frequent n-grams (found by counting
every batch of all the data; any set of them is right, it only sets the cost),
the others first, and by hash otherwise. A pair is looked at in the region of
its first shared n-gram only if what follows that in both could still make a
link, which parts copies whose own words come first.

1. Every member is compared with its regions' pivots, each pair once. The
   sets' sizes and parity sketches bound distances from below, without loss;
   the pairs that remain are compared exactly. Distances at most r are links.
2. Members linked with the pivot are joined through it. A region with members
   outside its pivot's component is joined once more: each of these against
   every member of another component in the triangle-inequality window, where
   the known bounds of both distances to the pivot differ by at most r. What
   the bounds leave is compared exactly. (One pass: members of a region that
   are unrelated are all at distance 1, so pivots of a further recursion would
   part off nothing but themselves.)
3. Components of all links, by contraction in Spark.

Every pair that could link shares a region, and there it has the pivot in it,
or lies in one component already, or is joined in step 2: nothing is lost.

Documents without words have no n-grams and link with nothing; with fewer
words than n, the whole sequence is the one n-gram. Repeated rows are
documents of their own, null ids never win as a component's smallest id, and
extra columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import (
    ascii_lower,
    distinct_by_row,
    group_sums,
    mix64,
    release_tables,
    sendable,
    slices,
    smallest_reachable,
    span_hashes,
    utf8_view,
    with_key,
    without_key,
    word_shingles,
    word_spans,
)
from tiermill.session import cut_lineage

#: N-grams in so many documents or more go last in the order, the more the later.
FREQUENT = 32
#: N-grams that a task counts at once (8 bytes each, and as much again to sort them).
COUNTED_AT_ONCE = 4_000_000
#: If there are more of them than so many (9 bytes each, sent to all tasks), only the most frequent do.
MOST_SENT = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-grams of each row, sorted."""
    starts, ends, bounds = word_spans(data, offsets)
    return distinct_by_row(*word_shingles(span_hashes(ascii_lower(data), starts, ends), bounds, words))


def _per_slice(batches: Iterator[pa.RecordBatch], words: int):
    """(batch, first row, rows, row, hash) of each slice of the batches' texts."""
    for batch in batches:
        data, offsets = utf8_view(batch.column(batch.schema.get_field_index("text")))
        for a, b in slices(offsets):
            yield batch, a, b - a, *shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], words)


def frequent_shingles(rows: DataFrame, words: int, least: int = FREQUENT, most: int = MOST_SENT) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, binary logarithms of their counts) of n-grams counted ``least`` times or more, at most ``most`` of them.

    Counted are those that stand in three documents of some run of
    ``COUNTED_AT_ONCE`` n-grams at least: the order is right with any set of
    them, and one that stands in a large part of the corpus does so in some run.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        held: list[np.ndarray] = []

        def often() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(h[n >= 3].view(np.int64)), pa.array(n[n >= 3].astype(np.int64))], names=["token", "n"])

        for _, _, _, _, h in _per_slice(batches, words):
            held.append(h)
            if sum(map(len, held)) > COUNTED_AT_ONCE:
                yield often()
        yield often()

    seen = rows.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    seen = cut_lineage(seen.where(F.col("n") >= least))
    # the least power of two that leaves few enough: one row for each power
    sizes = {r["p"]: r["c"] for r in seen.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    power = next((p for p in sorted(sizes) if sum(c for q, c in sizes.items() if q >= p) <= most), 64)
    got = seen.where(F.floor(F.log2("n")) >= power).toPandas()
    token, n = got["token"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    order = np.argsort(token)
    return token[order], np.log2(np.maximum(n, 1)).astype(np.uint8)[order]


def features(rows: DataFrame, words: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, id, n, h1, h2, sketch, wide, prefix) of each row: set size, set hash, parity sketches, prefix n-grams in order."""
    spark = rows.sparkSession
    last = spark.sparkContext.broadcast(frequent)
    schema = "key long, id long, n long, h1 long, h2 long, sketch binary, wide array<long>, prefix array<long>"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        often, level = last.value
        for batch, a, rows_, row, h in _per_slice(batches, words):
            n = np.bincount(row, minlength=rows_)
            bounds = np.concatenate([[0], np.cumsum(n)])
            h1 = group_sums(mix64(h), bounds)
            h2 = group_sums(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), bounds)
            sketch = [_sketch(h[bounds[i] : bounds[i + 1]]) for i in range(rows_)]
            wide = np.frombuffer(b"".join(_sketch(h[bounds[i] : bounds[i + 1]], _WIDE) for i in range(rows_)), np.int64)
            late = np.zeros(len(h), np.int64)
            if len(often):
                at = np.minimum(np.searchsorted(often, h), len(often) - 1)
                late = np.where(often[at] == h, 1 + level[at].astype(np.int64), 0)
            order = np.argsort(row * 128 + late, kind="stable")
            size = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
            first = np.arange(len(h)) - bounds[row] < size[row]
            prefix = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)),
                pa.array(h[order][first].view(np.int64)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).slice(a, rows_) for c in ("key", "id")]
                + [pa.array(n.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                   pa.array(sketch, pa.binary()),
                   pa.ListArray.from_arrays(pa.array(np.arange(rows_ + 1, dtype=np.int32) * (_WIDE // 64)), pa.array(wide)), prefix],
                names=["key", "id", "n", "h1", "h2", "sketch", "wide", "prefix"],
            )

    return rows.select("key", "id", "text").mapInArrow(apply, schema)


#: Bits of the sketch that all sets have alike, for use inside Spark's joins.
_WIDE = 512


def _sketch(h: np.ndarray, bits: int | None = None) -> bytes:
    """Parity of the elements in each of ``bits`` places (at least len(h), a power of two, if not given)."""
    bits = bits or max(64, 1 << max(0, len(h) - 1).bit_length())
    parity = np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of elements in one of two sets only, from their sketches."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _bounded(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y, na, nb, least) of pairs (x, y): sizes, and a lower bound of the symmetric difference."""
    a = sets.select(F.col("key").alias("x"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sets.select(F.col("key").alias("y"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "x").join(b, "y").select("x", "y", "na", "nb", "sa", "sb")
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = (batch.column(i).to_pylist() for i in (4, 5))
            least = [least_difference(p, q) if p is not None else 0 for p, q in zip(sa, sb, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(least, pa.int64())],
                                             names=["x", "y", "na", "nb", "least"])

    # pairs that their sizes part need no sketch
    both = both.withColumn("sa", F.when(near, F.col("sa"))).withColumn("sb", F.when(near, F.col("sb")))
    got = both.mapInArrow(apply, "x long, y long, na long, nb long, least long")
    return got.withColumn("least", F.greatest("least", F.abs(F.col("na") - F.col("nb"))))


def _may_link(percent: int):
    return F.col("least") * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)


def _sets_of(rows: DataFrame, keys: DataFrame, words: int) -> DataFrame:
    """(key, elements) of the rows with these keys; elements: distinct 64-bit n-gram hashes."""
    wanted = rows.select("key", "text").join(sendable(cut_lineage(keys.distinct())), "key", "left_semi")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch, a, n, row, h in _per_slice(batches, words):
            ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, n), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))],
                names=["key", "elements"])

    return wanted.mapInArrow(apply, "key long, elements array<long>")


def _shared(rows: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """(x, y, shared): the exact number of shared n-grams of pairs (x, y)."""
    pairs = cut_lineage(pairs.select("x", "y"))
    sets = cut_lineage(_sets_of(rows, pairs.select(F.explode(F.array("x", "y")).alias("key")), words))
    both = pairs.join(sets.toDF("x", "ex"), "x").join(sets.toDF("y", "ey"), "y")
    return both.select("x", "y", F.size(F.array_intersect("ex", "ey")).cast("long").alias("shared"))


def _links(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Adds na, nb and whether the pair links."""
    a, b = sets.select(F.col("key").alias("x"), F.col("n").alias("na")), sets.select(F.col("key").alias("y"), F.col("n").alias("nb"))
    return shared.join(a, "x").join(b, "y").withColumn(
        "linked", F.col("shared") * 100 >= (F.col("na") + F.col("nb") - F.col("shared")) * percent)


def components(rows: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(key, id, n, component, component_id) of (key, id, text) rows: the set size and the component.

    ``component`` is the smallest key in it, ``component_id`` the smallest id.
    """
    feat = cut_lineage(features(rows, words, percent, frequent_shingles(rows, words)))
    full = feat.where("n > 0")
    classes = cut_lineage(full.groupBy("h1", "h2").agg(F.min("key").alias("rep")))
    sets = cut_lineage(full.join(classes.select(F.col("rep").alias("key")), "key", "left_semi").select("key", "n", "sketch", "wide", "prefix"))
    # left: n-grams from this one on
    held = sets.select("key", "n", F.posexplode("prefix").alias("place", "token")).select(
        "token", "key", (F.col("n") - F.col("place")).cast("int").alias("left"), F.col("n").cast("int").alias("n"))
    regions = held.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "left", "n")).alias("p")).where("c > 1")
    members = cut_lineage(held.join(
        regions.select("token", F.col("p.key").alias("pivot"), F.col("p.left").alias("pivot_left"), F.col("p.n").alias("pivot_n")),
        "token"))
    sets = sets.drop("prefix")

    def could_link(left_x, n_x, left_y, n_y):
        most = F.least(left_x, left_y)
        return most * (100 + percent) >= (n_x + n_y) * percent

    # 1: members and pivots
    c = F.col
    pairs = members.where("key <> pivot").where(could_link(c("left"), c("n"), c("pivot_left"), c("pivot_n")))
    pairs = pairs.select(F.col("key").alias("x"), F.col("pivot").alias("y")).distinct()
    bound = cut_lineage(_bounded(pairs, sets, percent))
    shared = cut_lineage(_shared(rows, bound.where(_may_link(percent)), words))
    links = _links(shared, sets, percent).where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = cut_lineage(links)
    joined = smallest_reachable(links)

    # 2: members outside their pivot's component
    total = F.col("na") + F.col("nb")
    known = bound.join(shared, ["x", "y"], "left").select(
        F.col("x").alias("key"), F.col("y").alias("pivot"),
        F.coalesce(1 - F.col("shared") / (total - F.col("shared")), 2 * F.col("least") / (total + F.col("least"))).alias("lo"),
        F.coalesce(1 - F.col("shared") / (total - F.col("shared")), F.lit(1.0)).alias("hi"),
    )
    member = (
        members.join(joined.toDF("key", "root"), "key", "left")
        .select("token", "key", "pivot", "left", "n", F.coalesce("root", "key").alias("comp"))
    )
    member = cut_lineage(member)
    open_ = member.groupBy("token").agg(F.min("comp").alias("p"), F.max("comp").alias("q")).where("p <> q").select("token")
    member = (
        member.join(open_, "token", "left_semi")
        .join(known, ["key", "pivot"], "left")
        .join(joined.toDF("pivot", "pivot_root"), "pivot", "left")
        .select("token", "key", "comp", "n", "left", F.coalesce("lo", F.lit(0.0)).alias("lo"), F.coalesce("hi", F.lit(1.0)).alias("hi"),
                (F.col("key") == F.col("pivot")).alias("is_pivot"),
                (F.col("comp") != F.coalesce("pivot_root", "pivot")).alias("outside"))
    )
    member = member.where("not is_pivot").drop("is_pivot").join(sets.select("key", "wide"), "key")
    member = cut_lineage(member)
    y, x = member.where("outside").alias("y"), member.alias("x")
    apart = sum((F.bit_count(c("x.wide")[i].bitwiseXOR(c("y.wide")[i])) for i in range(_WIDE // 64)), F.lit(0))
    r = 1 - percent / 100 + 1e-9
    again = y.join(
        x,
        (F.col("y.token") == F.col("x.token")) & (F.col("y.comp") != F.col("x.comp"))
        & (~F.col("x.outside") | (F.col("x.key") < F.col("y.key")))
        & could_link(c("x.left"), c("x.n"), c("y.left"), c("y.n"))
        & (apart * (100 + percent) <= (c("x.n") + c("y.n")) * (100 - percent))
        & (F.col("y.lo") - F.col("x.hi") <= r) & (F.col("x.lo") - F.col("y.hi") <= r),
    ).select(F.col("x.key").alias("x"), F.col("y.key").alias("y")).distinct()
    close = _bounded(again, sets, percent).where(_may_link(percent))
    more = _links(_shared(rows, close, words), sets, percent).where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))

    # 3: components of all links, then of all rows
    roots = smallest_reachable(links.union(more)).toDF("rep", "root")
    named = classes.join(roots, "rep", "left").select("h1", "h2", F.coalesce("root", "rep").alias("root"))
    rows_of = feat.join(named, ["h1", "h2"], "left").select(
        "key", "id", "n", F.when(F.col("n") > 0, F.col("root")).otherwise(F.col("key")).alias("component"))
    rows_of = cut_lineage(rows_of)
    smallest = rows_of.groupBy("component").agg(F.min("id").alias("component_id"))
    return rows_of.join(smallest, "component").select("key", "id", "n", "component", "component_id")


def one_per_component(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` but for all of a component except one, of the smallest id."""
    rows = with_key(docs, id_col, text_col, rest=True)
    found = components(rows, words, percent)
    stays = F.min_by("key", F.struct(F.isnull("id"), "id", "key")).alias("stays")
    drop = found.join(found.groupBy("component").agg(stays), "component").where("key <> stays").select("key")
    return without_key(rows.join(sendable(cut_lineage(drop)), "key", "left_anti"), docs, id_col, text_col)
