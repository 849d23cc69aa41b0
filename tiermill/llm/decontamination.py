"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Words are runs of ASCII letters and digits and of non-ASCII bytes, without
ASCII case. A benchmark item of n words is compared with windows of n words of
every document (a document of fewer words is one window), by the weighted
Jaccard index of their ``k``-word shingles (an item of fewer words is one shingle). A shingle that stands in
m distinct item texts of the whole benchmark weighs 1 / m, others 1. A
document leaks an item if some window reaches ``threshold`` by these weights,
or with weight 1 for all (so that passages which items share hide nothing);
``similarity`` is the greater of the two.

* Only windows that hold one of the items' shingles can reach any similarity,
  so the words of all texts are read, but only stretches around such shingles
  go on. This loses nothing.
* Each window of a size that an item asks for has a 128-bit SimHash of its
  weighted shingles and, if items share any, one of the shingles with weight 1.
  Sixteen blocks of eight bits are looked up in tables
  that list the items within two bits of each block value; by the pigeonhole
  principle every fingerprint within ``RADIUS`` = 47 bits is among those found.
* Candidates within the radius are verified exactly, all windows of a stretch
  together: the weights that distinct shingles add to each window are running
  sums, so a document that repeats a phrase of many items costs its length
  times those items. Of equally similar windows the first counts.

The radius is a generous one for the default threshold: windows of similarity
0.8 differ in about 20 bits of 128 with a deviation of 4, so that a window
beyond 47 is more than six deviations off.

Items are read in blocks of bounded size (one block for all common
benchmarks); each block is a map over the documents. The shingles that items
share, with their counts, are made in Spark and go to every block. Null and empty texts and
items match nothing; repeated rows and items are each on their own, extra
columns do not matter, and an empty table (of either kind) gives an empty
result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import (
    ascii_lower,
    distinct_by_row,
    mix64,
    release_tables,
    sendable,
    slices,
    span_hashes,
    utf8_view,
    with_key,
    without_key,
    word_shingles,
)
from tiermill.session import cut_lineage

BITS = 128
RADIUS = 47
_BLOCKS = BITS // 8
_NEAR = 2
#: Pairs of a window and an item looked up at once.
PAIRS_AT_ONCE = 1 << 20
#: Text bytes of items in one block.
ITEM_BYTES = 4 << 20

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each row)."""
    inside = _WORD[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1] | border[1:-1]
        last[:-1] &= ~inside[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    return span_hashes(ascii_lower(data), starts, np.flatnonzero(last) + 1), np.searchsorted(starts, offsets)


def _signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each shingle and bit."""
    halves = np.stack([mix64(shingles), mix64(shingles ^ np.uint64(0xA0761D6478BD642F))], 1)
    return np.unpackbits(halves.view(np.uint8), axis=1).astype(np.float32) * 2 - 1


def window_fingerprints(shingles: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The 16 fingerprint bytes of every run of ``size`` shingles."""
    total = np.zeros((len(shingles) + 1, BITS))
    np.cumsum(_signs(shingles) * weights[:, None], axis=0, out=total[1:])
    return np.packbits(total[size:] - total[:-size] > 0, axis=1)


def _ones(shingles: np.ndarray) -> np.ndarray:
    return np.ones(len(shingles))


class ItemIndex:
    """Items of one shingle width: their shingles, weights and block tables by window size."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], shared: tuple[np.ndarray, np.ndarray] | None = None):
        """``shared``: sorted shingles of several items and their counts; without it, they are counted here."""
        self.items = items
        every, count = np.unique(np.concatenate([np.unique(s) for _, s in items]), return_counts=True)
        self.shingles = every
        self.shared, count = shared if shared is not None else (every[count > 1], count[count > 1])
        self.weight = 1.0 / count
        self.small = np.zeros(1 << 20, bool)
        self.small[(every & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.of_size: dict[int, list[int]] = defaultdict(list)
        self.where: dict[int, set[int]] = defaultdict(set)
        for i, (_, s) in enumerate(items):
            self.of_size[len(s)].append(i)
            for h in s.tolist():
                self.where[h].add(len(s))
        # fingerprints and tables by weight, and with weight 1 if that is not the same
        weighings = [self.weights_of, _ones] if len(self.shared) else [_ones]
        self.ways = [(weigh, *self._look_up(weigh)) for weigh in weighings]
        _, self.prints, self.tables = self.ways[0]

    def _look_up(self, weigh) -> tuple[np.ndarray, dict[int, list[np.ndarray]]]:
        prints = np.vstack([window_fingerprints(s, weigh(s), len(s)) for _, s in self.items])
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= _NEAR
        # tables[size][block][value]: which of the size's items are within two bits of that block value
        return prints, {size: [near[:, prints[which, b]] for b in range(_BLOCKS)] for size, which in self.of_size.items()}

    def weights_of(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.shared):
            return _ones(shingles)
        at = np.minimum(np.searchsorted(self.shared, shingles), len(self.shared) - 1)
        return np.where(self.shared[at] == shingles, self.weight[at], 1.0)

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Places of shingles that stand in an item."""
        maybe = np.flatnonzero(self.small[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.shingles, shingles[maybe]), len(self.shingles) - 1)
        return maybe[self.shingles[at] == shingles[maybe]]

    def matches(self, shingles: np.ndarray, known: np.ndarray, threshold: float) -> dict[int, tuple[float, int, int]]:
        """{item: (similarity, first shingle, Hamming distance)} of a document's best window for each leaked item."""
        sizes: dict[int, list[int]] = defaultdict(list)
        for place, h in zip(known.tolist(), shingles[known].tolist(), strict=True):
            for size in self.where[h]:
                sizes[size].append(place)
        best: dict[int, tuple[float, int, int]] = {}
        for size, places in sizes.items():
            for lo, hi in _stretches(places, size, len(shingles)):
                part = shingles[lo:hi]
                span = min(size, len(part))  # a shorter document is one window as a whole
                window, item, far = self._near(part, size, span)
                if not len(item):
                    continue
                windows = _Windows(part, span, [weigh for weigh, *_ in self.ways])
                for i in np.unique(item).tolist():
                    mine = item == i
                    w, d = window[mine], far[mine]
                    s = windows.similarity(self.items[i][1])[w]
                    at = int(np.lexsort((w, -s))[0])
                    found = (float(s[at]), lo + int(w[at]), int(d[at]))
                    if found[0] >= threshold and (-found[0], found[1]) < (-best.get(i, (0.0, 0, 0))[0], best.get(i, (0.0, 0, 0))[1]):
                        best[i] = found
        return best

    def _near(self, part: np.ndarray, size: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, Hamming distance) of windows and items of ``size`` within the radius, each pair once."""
        which, width = np.array(self.of_size[size]), 0
        found = []
        step = max(1, PAIRS_AT_ONCE // len(which))
        for weigh, item_prints, tables in self.ways:
            prints = window_fingerprints(part, weigh(part), span)
            width = len(prints)
            for a in range(0, width, step):
                some = prints[a : a + step]
                may = tables[size][0][some[:, 0]]
                for b in range(1, _BLOCKS):
                    may |= tables[size][b][some[:, b]]
                w, nth = np.nonzero(may)
                far = np.bitwise_count(some[w] ^ item_prints[which[nth]]).sum(axis=1).astype(np.int64)
                ok = far <= RADIUS
                found.append(np.stack([w[ok] + a, which[nth[ok]], far[ok]]))
        window, item, far = np.concatenate(found, axis=1)
        order = np.lexsort((far, window, item))  # the lesser distance of the two weighings
        window, item, far = window[order], item[order], far[order]
        one = np.concatenate([[True], (window[1:] != window[:-1]) | (item[1:] != item[:-1])]) if len(item) else np.zeros(0, bool)
        return window[one], item[one], far[one]


class _Windows:
    """All windows of ``span`` shingles of a stretch, for their exact similarity with an item.

    A shingle counts once in a window: its place counts for those windows that
    begin after its last place before, so that sums over distinct shingles of
    all windows are one running sum.
    """

    def __init__(self, part: np.ndarray, span: int, ways: list):
        n = len(part)
        order = np.argsort(part, kind="stable")
        again = part[order][1:] == part[order][:-1]
        before = np.full(n, -1)
        before[order[1:][again]] = order[:-1][again]
        self.part, self.count = part, n - span + 1
        self.first = np.maximum(before + 1, np.arange(n) - span + 1)
        self.past = np.minimum(np.arange(n), n - span) + 1
        self.some = self.first < self.past
        self.ways = [(weigh, w := weigh(part), self._sums(np.arange(n), w)) for weigh in ways]

    def _sums(self, places: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sum of the weights of the distinct shingles at ``places``, for every window."""
        places = places[self.some[places]]
        step = np.zeros(self.count + 1)
        np.add.at(step, self.first[places], weight[places])
        np.subtract.at(step, self.past[places], weight[places])
        return np.cumsum(step)[: self.count]

    def similarity(self, item: np.ndarray) -> np.ndarray:
        item = np.unique(item)
        at = np.minimum(np.searchsorted(item, self.part), len(item) - 1)
        places = np.flatnonzero(item[at] == self.part)
        out = np.zeros(self.count)
        for weigh, weight, total in self.ways:
            both = self._sums(places, weight)
            np.maximum(out, both / (total + weigh(item).sum() - both), out=out)
        return np.round(out, 12)  # running sums of weights; equal windows have equal results


def _stretches(places: list[int], size: int, n: int) -> Iterator[tuple[int, int]]:
    """Merged ranges of shingles that windows of ``size`` around the places reach."""
    lo = hi = None
    for p in sorted(places):
        a, b = max(0, p - size + 1), min(n, p + size)
        if hi is not None and a <= hi:
            hi = max(hi, b)
            continue
        if hi is not None:
            yield lo, hi
        lo, hi = a, b
    if hi is not None:
        yield lo, hi


def shared_shingles(items: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that stand in several distinct texts of ``items`` (text), and in how many."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column(0))
            for a, b in slices(offsets):
                words, bounds = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                _, h = distinct_by_row(*word_shingles(words, bounds, k))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    found = items.select("text").distinct().mapInArrow(apply, "h long").groupBy("h").count().where("count > 1").toArrow()
    h = found.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], found.column("count").to_numpy().astype(np.int64)[order]


def _indexes(items: list[tuple[int | None, bytes]], k: int, shared: tuple[np.ndarray, np.ndarray]) -> dict[int, ItemIndex]:
    """An index for each shingle width in use (``k``, and the lengths of shorter items)."""
    by_width: dict[int, list[tuple[int | None, np.ndarray]]] = defaultdict(list)
    for item, raw in items:
        words, bounds = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        if len(words):
            width = min(k, len(words))
            by_width[width].append((item, word_shingles(words, bounds, width)[1]))
    return {width: ItemIndex(found, shared) for width, found in by_width.items()}


def leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, k: int = 5,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(id_col, item_id, similarity, first_word, n_words, hamming): a document's best window for each item it leaks."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    items = benchmark.select(benchmark[item_id].cast("long").alias("item"), benchmark[item_text].alias("text")).where(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    shared = shared_shingles(items, k)
    schema = "id long, item long, similarity double, first_word long, n_words long, hamming long"
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        got = sorted(((r["item"], r["text"].encode()) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        index = spark.sparkContext.broadcast(_indexes(got, k, shared))
        out = out.union(rows.mapInArrow(_scan(index, threshold), schema))
    return out.withColumnsRenamed({"id": id_col, "item": item_id})


def _scan(index, threshold: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(1))
            found: list[tuple] = []
            for a, b in slices(offsets):
                words, bounds = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for width, items in index.value.items():
                    row, shingles = word_shingles(words, bounds, width)
                    known = items.known(shingles)
                    begin = np.searchsorted(row, np.arange(b - a + 1))
                    for r in np.unique(row[known]).tolist():
                        mine = known[(known >= begin[r]) & (known < begin[r + 1])] - begin[r]
                        if bounds[r + 1] - bounds[r] < width:
                            continue  # a shorter row's one shingle is of another width
                        best = items.matches(shingles[begin[r] : begin[r + 1]], mine, threshold)
                        for i, (s, at, d) in sorted(best.items()):
                            n = min(len(items.items[i][1]) + width - 1, int(bounds[r + 1] - bounds[r]))
                            found.append((batch.column(0)[a + r].as_py(), items.items[i][0], s, at, n, d))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*found, strict=True)) if found else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["id", "item", "similarity", "first_word", "n_words", "hamming"])

    return apply


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, k: int = 5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no item, whether or not their ids are null or shared."""
    rows = with_key(docs, id_col, text_col, rest=True)
    bad = leaks(rows.select("key", "text"), benchmark, threshold, k, "key", "text").select("key").distinct()
    return without_key(rows.join(sendable(cut_lineage(bad)), "key", "left_anti"), docs, id_col, text_col)
