"""Suffix-array deduplication of repeated passages, exact, over a whole corpus.

A place is repeated if the ``length`` units (bytes or words) from it also begin
somewhere else; no passage crosses a document's border. In a suffix array the
nearest smaller positions before and after a place, in suffix order, are where
its longest earlier factor begins (the longest-previous-factor array), and the
nearest larger ones where a later copy begins. ``keep="first"`` removes what
has an earlier match, ``keep="none"`` what has any; ``keep="shared"`` marks what
another document holds.

A corpus does not fit one suffix array, so places are dealt out by content:

1. Each window of ``length`` units names its least ``gram`` by hash (leftmost).
   Equal windows name the same gram at the same place, so only windows below one
   gram can be equal. The windows in a row that name one place (an anchor) are
   its context. Anchors whose gram stands nowhere else are done.
2. Contexts equal as a whole repeat as a whole; one of each (the first) goes on,
   so a group of copies, however large, is one context.
3. Contexts below one gram are cut into blocks of windows by distance from the
   anchor. All windows of a block share a core; windows of two blocks can only
   be equal if the cores are. Blocks equal as a whole repeat as a whole, again
   counted before the shuffle, and one of each goes on.
4. The blocks left below one core differ only beside it. In a task, core and
   sides stand as short strings (the core is one symbol) in one suffix array,
   built by prefix doubling, with its nearest smaller and larger positions.
5. Blocks below one core are dealt in parts of about ``part_rows``. Windows not
   settled inside their part (and one of each class that is) meet the other
   parts' by hash, so a core that a third of all documents hold is as exact as
   any other and no task holds it whole. Cores with few blocks have one part;
   the rule is the same.

Texts are shuffled only for documents with contexts that go on, and for those
with something to remove. A very long text is read in overlapping parts for its
anchors; its places and ranges are lists no longer than its text. Null and empty
texts have no units; texts shorter than ``length`` keep all. Ties (equal
windows) go by document key, then place. Repeated rows are documents of their
own (and copies of each other), extra columns do not matter, and an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import (
    SLICE_BYTES,
    _powers,
    mix64,
    release_tables,
    sendable,
    slices,
    sliding_min,
    span_hashes,
    utf8_view,
    with_key,
    without_key,
    word_spans,
)
from tiermill.session import cut_lineage

_PLACE = 22  # bits of a place inside a slice; the rest of a word orders grams
#: Blocks that a context has at most.
BLOCKS = 7
#: Blocks in a part of those below one core, about.
PART_ROWS = 2000
#: Symbols that one suffix array takes, about.
ARRAY_SYMBOLS = 1 << 20


class _Hashes:
    """Hashes of any span of some symbols, in constant time each."""

    def __init__(self, data: np.ndarray):
        p = _powers(len(data) + 1)
        self.down = p.down
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p.up[: len(data)], out=self.prefix[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[ends] - self.prefix[starts]) * self.down[starts])

    def all_of(self, size: int) -> np.ndarray:
        n = len(self.prefix) - size
        return mix64((self.prefix[size:] - self.prefix[:n]) * self.down[:n])


# -- symbols -------------------------------------------------------------


def _word_parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(base, bytes, offsets) of rows, one longer row in parts that end between words."""
    if len(offsets) != 2 or len(data) <= 4 * SLICE_BYTES:
        yield 0, data, offsets
        return
    a = 0
    while a < len(data):
        b = min(len(data), a + SLICE_BYTES)
        while b < len(data) and data[b] != 32 and not 9 <= data[b] <= 13:
            b += 1
        yield a, data[a:b], np.array([0, b - a])
        a = b


def _symbols(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of a slice's rows: its bytes, or 64-bit hashes of its words."""
    if unit == "bytes":
        return data, offsets
    found = [(span_hashes(part, *spans[:2]), spans[2]) for _, part, off in _word_parts(data, offsets) for spans in [word_spans(part, off)]]
    if len(found) == 1:
        return found[0]
    words = np.concatenate([w for w, _ in found])
    return words, np.array([0, len(words)])


def _word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of a text's words."""
    found = [(base + s, base + e) for base, part, off in _word_parts(data, np.array([0, len(data)])) for s, e, _ in [word_spans(part, off)]]
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


# -- anchors and their contexts --------------------------------------------


def _anchors_of(symbols: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, place, first window, last window, gram hash, context hash) of the anchors of a slice's rows.

    Places count from the row's start. The windows that name an anchor follow each other.
    """
    if len(symbols) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z, z.view(np.uint64), z.view(np.uint64)
    hashes = _Hashes(symbols)
    grams = hashes.all_of(gram)
    order = (mix64(grams) >> np.uint64(_PLACE)) << np.uint64(_PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(order, length - gram + 1)
    row = np.searchsorted(offsets, np.arange(len(least)), side="right") - 1
    inside = np.flatnonzero(np.arange(len(least)) + length <= offsets[row + 1])
    at = (least[inside] & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
    first, last = inside[head], inside[np.append(head[1:], len(at))[: len(head)] - 1]
    at = at[head]
    shape = mix64(((at - first) * (length + 1) + (last - first)).astype(np.uint64))
    base = offsets[np.searchsorted(offsets, at, side="right") - 1]
    row = np.searchsorted(offsets, at, side="right") - 1
    return row, at - base, first - base, last - base, grams[at], mix64(hashes.of(first, last + length) + shape)


def _pieces(symbols: np.ndarray, offsets: np.ndarray, length: int):
    """Rows as (symbols, offsets, base, own from, own to); a long row comes in overlapping parts.

    A part overlaps its neighbours by twice the length, so all windows that
    name one of its own anchors lie in it. ``base`` is its place in the row.
    """
    if len(symbols) <= 1 << (_PLACE - 1):
        yield symbols, offsets, 0, 0, len(symbols)
        return
    for s in range(0, len(symbols), SLICE_BYTES):
        lo, hi = max(0, s - 2 * length), min(len(symbols), s + SLICE_BYTES + 2 * length)
        yield symbols[lo:hi], np.array([0, hi - lo]), lo, s, s + SLICE_BYTES


def anchors(rows: DataFrame, unit: str, length: int, gram: int) -> DataFrame:
    """(kh, ch, key, pos, first, last): gram hash, context hash, document, place and windows of every anchor."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(1))
            keys = batch.column(0).to_numpy()
            for a, b in slices(offsets):
                whole = _symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], unit)
                for part, off, base, lo, hi in _pieces(*whole, length):
                    found = _anchors_of(part, off, length, gram)
                    if len(part) < len(whole[0]):  # a part of a long row: its own anchors only
                        own = (found[1] + base >= lo) & (found[1] + base < hi)
                        found = [c[own] for c in found]
                    row, at, first, last, kh, ch = found
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(kh.view(np.int64)), pa.array(ch.view(np.int64)), pa.array(keys[a + row]),
                         *[pa.array((c + base).astype(np.int64)) for c in (at, first, last)]],
                        names=["kh", "ch", "key", "pos", "first", "last"])

    return rows.select("key", "text").mapInArrow(apply, "kh long, ch long, key long, pos long, first long, last long")


# -- blocks of windows -------------------------------------------------------


def _spans(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The symbols of each span, as binary values."""
    size = ends - starts
    flat = symbols[np.repeat(starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]
    borders = np.concatenate([[0], np.cumsum(size)]).astype(np.int32) * symbols.itemsize
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(borders.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _blocks_of(symbols: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, block: int):
    """(context, block, core hash, full hash, first window, windows, left, right) of the blocks of some contexts.

    Block j holds the windows that start from j * block to (j + 1) * block - 1
    before the anchor. Its core is what all of them hold, left and right what
    the context's windows hold beside it.
    """
    deepest = (at - first) // block
    shallowest = (at - last) // block
    count = deepest - shallowest + 1
    of = np.repeat(np.arange(len(at)), count)
    j = shallowest[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    most = at[of] - j * block
    least = most - block + 1
    a, b = np.maximum(least, first[of]), np.minimum(most, last[of])
    hashes = _Hashes(symbols)
    core = hashes.of(most, least + length)
    full = mix64(hashes.of(a, b + length) + mix64(((a - least) * block + (most - b)).astype(np.uint64)))
    return of, j, core, full, a, b - a + 1, _spans(symbols, a, most), _spans(symbols, least + length, b + length)


def window_ranks(symbols: np.ndarray, length: int) -> np.ndarray:
    """Rank of symbols[i : i + length] in suffix order for every i, by prefix doubling.

    Strings that go past the end sort before those that go on.
    """
    n = len(symbols)
    rank, size = _rank(symbols), 1
    while size < length:
        step = min(size, length - size)
        after = np.zeros(n, np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        rank = _rank(rank * (n + 1) + after)
        size += step
    return rank


def _rank(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values)
    ordered = values[order]
    rank = np.empty(len(values), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return rank


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each, or -1; by pointer jumping."""
    to = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(to >= 0)
    while len(open_):
        open_ = open_[(to[open_] >= 0) & (values[to[open_]] >= values[open_])]
        to[open_] = to[to[open_]]
        open_ = open_[to[open_] >= 0]
    return to


def has_match(rank: np.ndarray, place: np.ndarray, later: bool = False) -> np.ndarray:
    """Whether each suffix has an earlier (or later) one of equal rank.

    Its longest previous factor begins at the nearest smaller position before
    or after it in suffix order; ranks are cut to the window's length, so that
    factor is a whole window where the ranks are equal.
    """
    order = np.argsort(rank, kind="stable")
    r, p = rank[order], -place[order] if later else place[order]
    before, after = previous_smaller(p), len(p) - 1 - previous_smaller(p[::-1])[::-1]
    found = (before >= 0) & (r[before] == r)
    found |= (after < len(p)) & (r[np.minimum(after, len(p) - 1)] == r)
    out = np.empty(len(rank), bool)
    out[order] = found
    return out


_MATCH = "key long, lo long, hi long, kh long, block int, core long, distance int, wh long, settled boolean"


def _match(rows: list[tuple], block: int, length: int, keep: str, kind: type) -> pa.RecordBatch:
    """Windows of blocks (kh, block, core, part, key, lo, n, left, right, times, far, parts) that repeat, as ranges.

    From cores with several parts also the windows that another part may
    settle, and one of each class that is settled.
    """
    kh, blk, core, part, key, lo, n, left, right, times, far, parts = zip(*rows, strict=True)
    kh, blk, core, key, lo, n, times, parts = (np.array(c, np.int64) for c in (kh, blk, core, key, lo, n, times, parts))
    far = np.array(far, bool)
    group = np.cumsum([True] + [rows[i][:4] != rows[i - 1][:4] for i in range(1, len(rows))]) - 1
    sides = [np.frombuffer(b"".join(c), kind).astype(np.uint64) for c in (left, right)]
    width = np.dtype(kind).itemsize
    size = [np.array([len(x) // width for x in c]) for c in (left, right)]
    total = size[0] + 1 + size[1]
    start = np.cumsum(total) - total
    raw = np.empty(int(total.sum()), np.uint64)
    for flat, each, begin in ((sides[0], size[0], start), (sides[1], size[1], start + size[0] + 1)):
        raw[np.repeat(begin - np.cumsum(each) + each, each) + np.arange(len(flat))] = flat
    middle = start + size[0]
    raw[middle] = core.view(np.uint64)
    _, symbols = np.unique(raw, return_inverse=True)
    symbols[middle] = len(raw) + group  # a core is one symbol, of its own in every group
    owner = np.repeat(np.arange(len(rows)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = start[owner] + within
    rank = _rank(window_ranks(symbols, block)[at])
    who, where = key[owner], lo[owner] + within
    place = np.empty(len(at), np.int64)
    place[np.lexsort((where, who))] = np.arange(len(at))
    if keep == "shared":
        least, most = np.full(len(at), np.iinfo(np.int64).max), np.full(len(at), np.iinfo(np.int64).min)
        np.minimum.at(least, rank, who)
        np.maximum.at(most, rank, who)
        spread = least < most
        spread[rank[far[owner]]] = True
        hit = spread[rank]
    else:
        hit = has_match(rank, place)
        if keep == "none":
            hit |= has_match(rank, place, later=True)
    hits = np.flatnonzero(hit)
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]])])) if len(hits) else hits
    ends = np.append(cut[1:], len(hits))[: len(cut)] - 1
    # what other parts may settle
    open_ = np.flatnonzero((parts[owner] > 1) & ~hit)
    known = open_[:0]
    if keep != "first":
        known = np.flatnonzero((parts[owner] > 1) & (hit | (times[owner] > 1)))
        known = known[np.unique(rank[known], return_index=True)[1]]
    ask = np.concatenate([open_, known])
    wh = _Hashes(raw).of(at[ask], at[ask] + block) if len(ask) else np.zeros(0, np.uint64)
    none = np.zeros(len(cut), np.int64)
    settled = np.concatenate([np.zeros(len(open_), bool), np.ones(len(known), bool)])
    mark = np.concatenate([np.ones(len(cut), bool), np.zeros(len(ask), bool)])

    def column(a: np.ndarray, b: np.ndarray, t: pa.DataType, marks_too: bool = False) -> pa.Array:
        return pa.array(np.concatenate([a, b]), t, mask=None if marks_too else mark)

    own = owner[ask]
    return pa.RecordBatch.from_arrays(
        [column(who[hits[cut]], who[ask], pa.int64(), True), column(where[hits[cut]], where[ask], pa.int64(), True),
         column(where[hits[ends]] + length, where[ask] + length, pa.int64(), True), column(none, kh[own], pa.int64()),
         column(none, blk[own], pa.int32()), column(none, core[own], pa.int64()),
         column(none, size[0][own] - within[ask], pa.int32()), column(none, wh.view(np.int64), pa.int64()),
         column(none.astype(bool), settled, pa.bool_())],
        names=[c.split()[0] for c in _MATCH.split(", ")])


# -- all repeats -----------------------------------------------------------------


def _other(keep: str, first: Column, me: Column, times: Column, far: Column) -> Column:
    """Whether a member of a class is marked, from the class's first member, size and spread over documents."""
    return {"none": times > 1, "first": me != first, "shared": far}[keep]


def repeats(
    rows: DataFrame, length: int, unit: str = "bytes", keep: str = "none", gram: int | None = None, part_rows: int = PART_ROWS,
) -> DataFrame:
    """(key, lo, hi): places [lo, hi), in units, of (key, text) rows that are marked; they may overlap.

    With ``keep="shared"`` every document that shares a passage has a range;
    copies of a passage inside one document may be without.
    """
    gram = gram or max(1, min(100, length // 4))
    block = -(-(length - gram + 1) // BLOCKS)
    kind = np.uint8 if unit == "bytes" else np.uint64
    place = ["kh", "block", "core"]
    found = cut_lineage(anchors(rows, unit, length, gram))
    context = cut_lineage(found.groupBy("kh", "ch").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "pos", "first", "last")).alias("one"),
        (F.min("key") < F.max("key")).alias("far")))
    # whole contexts that stand elsewhere
    many = cut_lineage(context.where("times > 1"))
    whole = found.join(many, ["kh", "ch"]).where(_other(
        keep, F.struct(F.col("one.key"), F.col("one.pos")), F.struct("key", "pos"), F.col("times"), F.col("far")))
    whole = whole.select("key", found["first"].alias("lo"), (found["last"] + length).alias("hi"))
    # one of each context below a gram that has several
    several = cut_lineage(context.groupBy("kh").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("kh"))
    mine = context.join(several, "kh").select("kh", "far", "one.*")
    asked = cut_lineage(mine.groupBy("key").agg(F.collect_list(F.struct("pos", "first", "last", "kh", "far")).alias("places")))
    texts = rows.select("key", "text").join(sendable(asked.select("key")), "key", "left_semi").join(asked, "key")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(1))
            keys, lists = batch.column(0).to_numpy(), batch.column(2)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            flat = lists.flatten()
            places = [flat.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "first", "last", "kh", "far")]
            for a, b in slices(offsets):
                symbols, off = _symbols(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], unit)
                row = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                pos, first, last, kh, far = (c[ends[a] : ends[b]] for c in places)
                base = off[row]
                of, j, core, full, lo, n, left, right = _blocks_of(symbols, base + pos, base + first, base + last, length, block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kh[of]), pa.array(j.astype(np.int32)), pa.array(core.view(np.int64)), pa.array(full.view(np.int64)),
                     pa.array(keys[a + row[of]]), pa.array(lo - base[of]), pa.array(n.astype(np.int32)), left, right, pa.array(far[of].astype(bool))],
                    names=["kh", "block", "core", "full", "key", "lo", "n", "left", "right", "far"])

    each = cut_lineage(texts.select("key", "text", "places").mapInArrow(
        gather, "kh long, block int, core long, full long, key long, lo long, n int, left binary, right binary, far boolean"))
    same = cut_lineage(each.groupBy(*place, "full").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "lo")).alias("one"),
        ((F.min("key") < F.max("key")) | F.max("far")).alias("spread")))
    cores = cut_lineage(same.groupBy(*place).agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    named = cut_lineage(same.join(cores, place, "left").where("times > 1 or kinds > 1 or spread"))
    is_one = F.struct("key", "lo") == F.col("one")
    goes_on = is_one & (F.coalesce("kinds", F.lit(0)) > 1)
    both = each.join(named, [*place, "full"]).select(
        *place, "key", "lo", "n", "times", F.col("spread").alias("far"), "kinds", goes_on.alias("goes_on"),
        _other(keep, F.col("one"), F.struct("key", "lo"), F.col("times"), F.col("spread")).alias("marked"),
        *[F.when(goes_on, F.col(c)).alias(c) for c in ("left", "right")])
    both = cut_lineage(both)
    alike = both.where("marked").select("key", "lo", (F.col("lo") + F.col("n") - 1 + length).alias("hi"))

    # blocks that differ beside their core, in parts
    parts = F.ceil(F.col("kinds") / part_rows).cast("int")
    left = both.where("goes_on").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("key", "lo"), F.col("parts")).cast("int"))
    left = left.repartition(*place, "part").sortWithinPartitions(*place, "part")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups lie one after the other; as many as fit share a suffix array."""
        release_tables()
        todo: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size > ARRAY_SYMBOLS and row[:4] != todo[-1][:4]:
                    yield _match(todo, block, length, keep, kind)
                    todo, size = [], 0
                todo.append(row)
                size += 2 * block
        if todo:
            yield _match(todo, block, length, keep, kind)

    met = left.select(*place, "part", "key", "lo", "n", "left", "right", "times", "far", "parts").mapInArrow(meet, _MATCH)
    met = cut_lineage(met)
    inside = met.where("kh is null").select("key", "lo", "hi")
    window = [*place, "distance", "wh"]
    asking = met.where("kh is not null")
    classes = asking.groupBy(*window).agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "lo")).alias("one"),
        ((F.min("key") < F.max("key")) | F.max("settled")).alias("far")).where("times > 1")
    across = asking.where("not settled").join(cut_lineage(classes), window).where(
        _other(keep, F.col("one"), F.struct("key", "lo"), F.col("times"), F.col("far"))).select("key", "lo", "hi")
    return whole.union(alike).union(inside).union(across)


def _covered(ranges: pa.Array, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row, the merged (starts, ends) of its list of byte ranges, clipped to its size."""
    none = np.zeros(0, np.int64)
    flat = ranges.flatten()
    count = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    last = np.cumsum(count)
    lo, hi = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "hi"))
    for size, a, b in zip(sizes, last - count, last, strict=True):
        if a == b:
            yield none, none
            continue
        order = np.argsort(lo[a:b], kind="stable")
        start, end = np.maximum(lo[a:b][order], 0), np.maximum.accumulate(np.minimum(hi[a:b][order], size))
        at = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
        yield start[at], end[np.append(at[1:] - 1, b - a - 1)]


def _range_lists(ranges: DataFrame, name: str) -> DataFrame:
    return ranges.groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias(name))


def _with_ranges(rows: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(touched, rest): the rows with ``ranges``, a list, and the others."""
    lists = cut_lineage(_range_lists(ranges, "ranges"))
    keys = sendable(cut_lineage(lists.select("key")))
    return rows.join(keys, "key", "left_semi").join(lists, "key"), rows.join(keys, "key", "left_anti")


def digest(
    docs: DataFrame, length: int = 400, keep: str = "none", passage_words: int = 51, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, shares_passage) of every row.

    ``shares_passage`` is 1 if the row holds ``passage_words`` words in a row
    that another row holds as well, whatever their bytes, else 0.
    """
    rows = with_key(docs, id_col, text_col)
    touched, rest = _with_ranges(rows, repeats(rows, length, "bytes", keep))
    none = F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>")
    every = touched.select("key", "id", "text", "ranges").union(rest.select("key", "id", "text", none.alias("ranges")))
    schema = "key long, id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(2))
            rows = []
            for i, (a, b) in enumerate(_covered(batch.column(3), np.diff(offsets))):
                text = data[offsets[i] : offsets[i + 1]]
                sha, at = hashlib.sha256(), 0
                for lo, hi in zip(a, b, strict=True):
                    sha.update(text[at:lo])
                    at = hi
                sha.update(text[at:])
                rows.append((len(text), int((b - a).sum()), len(a), sha.hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
                names=["key", "id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    shared = cut_lineage(repeats(rows, passage_words, "words", "shared").select("key").distinct())
    shared = sendable(shared).withColumn("shares_passage", F.lit(1))
    out = every.mapInArrow(apply, schema).join(shared, "key", "left")
    return out.withColumn("shares_passage", F.coalesce("shares_passage", F.lit(0))).drop("key").withColumnRenamed("id", id_col)


def remove_repeats(
    docs: DataFrame, length: int, unit: str = "bytes", keep: str = "first", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with repeated passages of ``length`` units cut out of the text; its other columns as they are.

    Bytes are cut at whole UTF-8 characters, words from the start of the first
    to the end of the last of a passage. A null text stays null.
    """
    rows = with_key(docs, id_col, text_col, rest=True)
    touched, rest = _with_ranges(rows, repeats(rows, length, unit, keep))
    names = ["key", "id", "text", "rest"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(2))
            places = [_word_places(data[x:y]) for x, y in zip(offsets[:-1], offsets[1:], strict=True)] if unit == "words" else []
            sizes = np.array([len(p[0]) for p in places], np.int64) if unit == "words" else np.diff(offsets)
            texts = []
            for i, (a, b) in enumerate(_covered(batch.column(4), sizes)):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                if unit == "words":
                    a, b = places[i][0][a], places[i][1][b - 1]
                parts, at = [], 0
                for lo, hi in zip(a.tolist(), b.tolist(), strict=True):
                    while lo < hi and text[lo] & 0xC0 == 0x80:
                        lo += 1
                    while lo < hi < len(text) and text[hi] & 0xC0 == 0x80:
                        hi -= 1
                    parts.append(text[at:lo])
                    at = hi
                texts.append(b"".join([*parts, text[at:]]).decode())
            columns = [pa.array(texts, pa.string()) if i == 2 else batch.column(i) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = rows.select(*names).schema
    changed = touched.select(*names, "ranges").mapInArrow(apply, schema)
    return without_key(changed.union(rest.select(*names)), docs, id_col, text_col)
