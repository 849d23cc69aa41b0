"""Periodic runs in documents, by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``least`` words and two periods long, which no
neighbouring word extends keeping the period. All runs of a document are found:

1. Periods below ``LAGS`` by direct scans: words equal to the word q further on
   form stretches, a long enough one is a run.
2. Periods from P = 2**k to 2P - 1, for each k: every window of P/2 places
   names its least P/2-word gram (the leftmost, in an order by hash). Inside a
   run each window and the one a period later hold the same words, so both name
   the same gram at the same place: every run has two equal minimizers one
   period apart. Equal minimizers of a document are paired and extended.
3. Extension takes logarithmic time: grams of 2**j words have exact names (equal
   names for equal words, kept for grams that stand twice in the document), and
   a longest match is put together from them.

Equal minimizers that overlap by half or more lie in a stretch of a smaller
period p, and would make pairs in the square of its length. They are one
cluster with its p-periodic stretch; of two clusters only those distances are
tried at which the stretches' ends meet, or at which their overlap alone makes
a run, so that pairs follow the number of places and runs. Every stretch found
is kept under the least of its periods.

A document is searched within a task, documents of a slice together. Memory
follows the slice (``common.SLICE_BYTES``), or one longer text: about 100 bytes
a word, and 4 more a word for each doubling of the longest repeated passage.

Null, empty and white-space texts have no words and no runs. Equal words are
equal in all bytes. Runs over one stretch tie and are one run, of the smallest
period; runs of a document go by start, then period. Repeated rows are
documents of their own, null ids stay null, extra columns do not matter, and an
empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tiermill.llm.common import mix64, slices, sliding_min, utf8_view

#: Periods below this one are scanned directly; a power of two.
LAGS = 16


class _Grams:
    """Exact names of the grams of 2**k words that stand at least twice in their document; -1 for others."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = len(words)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.n, end = n, bounds[1:][row]
        self.names = [self._named(np.arange(n), row * (int(words.max()) + 1) + words)]
        size = 1
        while len(self.names[-1]) > size:
            last = self.names[-1]
            at = np.flatnonzero((last[:-size] >= 0) & (last[size:] >= 0))
            at = at[at + 2 * size <= end[at]]
            if not len(at):
                break
            named = self._named(at, last[at].astype(np.int64) * n + last[at + size])
            if named.max() < 0:
                break
            self.names.append(named)
            size *= 2

    def _named(self, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        names = np.full(self.n, -1, np.int32)
        _, name, times = np.unique(codes, return_inverse=True, return_counts=True)
        twice = times[name] > 1
        names[at[twice]] = name[twice]
        return names

    def match_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words from a on that equal those from b on, a < b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names = np.append(self.names[k], -1)  # the place past the end
            x = names[np.minimum(a, self.n)]
            more = (x >= 0) & (x == names[np.minimum(b, self.n)])
            a += more << k
            b += more << k
        return a - start

    def match_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words before a that equal those before b."""
        a, b = a.copy(), b.copy()
        start = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            x = names[np.maximum(a - (1 << k), 0)]
            more = (a >= 1 << k) & (x >= 0) & (x == names[np.maximum(b - (1 << k), 0)])
            a -= more << k
            b -= more << k
        return start - a


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the stretches of true values."""
    change = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _minimizers(names: np.ndarray, width: int) -> np.ndarray:
    """Places of the least named gram (leftmost, in hash order) of every window of ``width`` places, ascending."""
    n = len(names)
    if n < width:
        return np.zeros(0, np.int64)
    shift = np.uint64(max(1, n.bit_length()))
    none = np.uint64(2**64 - 1)
    order = (mix64(names.astype(np.uint64)) >> shift) << shift | np.arange(n, dtype=np.uint64)
    least = sliding_min(np.where(names >= 0, order, none), width)
    at = (least[least != none] & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _smallest_period(grams: _Grams, at: np.ndarray, size: int, gap: np.ndarray) -> np.ndarray:
    """Smallest period of the grams of ``size`` words at places ``at``, which have period ``gap`` (at most half the size)."""
    period = gap.copy()
    for g in np.unique(gap):
        of = np.flatnonzero(gap == g)
        for d in (d for d in range(1, int(g)) if g % d == 0):
            of = of[period[of] == g]
            if not len(of):
                break
            a = at[of]
            period[of[grams.match_after(a, a + d) >= size - d]] = d
    return period


def _pairs_of_clusters(name: np.ndarray, first: np.ndarray, last: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of clusters of one name with a distance from ``scale`` to twice that."""
    step = 1
    while step < len(name):
        a = np.arange(len(name) - step)
        b = a + step
        near = (name[a] == name[b]) & (first[b] - last[a] < 2 * scale)
        if not near.any():
            return
        near &= last[b] - first[a] >= scale
        yield a[near], b[near]
        step += 1


def _seeds(grams: _Grams, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) to be extended, periods from ``scale`` to twice that."""
    size = scale // 2
    names = grams.names[size.bit_length() - 1]
    at = _minimizers(names, size)
    if len(at) < 2:
        return at[:0], at[:0]
    order = np.argsort(names[at], kind="stable")
    at, name = at[order], names[at][order]
    new = np.concatenate([[True], (name[1:] != name[:-1]) | (at[1:] - at[:-1] > size // 2)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    first, last, name, several = at[head], at[tail], name[head], tail > head
    # the smallest period of a name's gram, where a cluster shows that it has one
    period = np.zeros(len(head), np.int64)
    if several.any():
        period[several] = _smallest_period(grams, first[several], size, at[head[several] + 1] - first[several])
        groups = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        period = np.repeat(np.maximum.reduceat(period, groups), np.diff(np.append(groups, len(name))))
    lo, hi = first.copy(), first.copy()
    some = period > 0
    if some.any():
        a, p = first[some], period[some]
        lo[some] = a - grams.match_before(a, a + p)
        hi[some] = a + p + grams.match_after(a, a + p)
    places, periods = [], []
    for a, b in _pairs_of_clusters(name, first, last, scale):
        plain = ~several[a] & ~several[b]
        x, q = first[a[plain]], first[b[plain]] - first[a[plain]]
        places.append(x)
        periods.append(q)
        a, b = a[~plain], b[~plain]
        a, b = (c[lo[a] != lo[b]] for c in (a, b))
        if not len(a):
            continue
        p, phase = period[a], (first[b] - first[a]) % period[a]
        # distances at which the overlap of the two stretches alone makes a run
        most = np.minimum.reduce([hi[a] - lo[a], hi[b] - lo[b], (hi[b] - lo[a]) // 2, np.full(len(a), 2 * scale - 1)])
        least = scale + (phase - scale) % p
        times = np.where(hi[a] >= lo[b], np.maximum((most - least) // p + 1, 0), 0)
        of = np.repeat(np.arange(len(a)), times)
        q = least[of] + p[of] * (np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times))
        places.append(np.maximum(lo[a][of], lo[b][of] - q))
        periods.append(q)
        # distances at which the stretches' ends meet
        for q in (lo[b] - lo[a], hi[b] - hi[a]):
            x = np.maximum(lo[a], lo[b] - q)
            ok = ((q - phase) % p == 0) & (np.minimum(hi[a], hi[b] - q) > x)
            places.append(x[ok])
            periods.append(q[ok])
    x, q = np.concatenate([at[:0], *places]), np.concatenate([at[:0], *periods])
    inside = (q >= scale) & (q < 2 * scale)
    return x[inside], q[inside]


def runs_of(words: np.ndarray, bounds: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all runs, by row, start and period.

    ``words`` are word numbers (equal for equal words), row i has
    words[bounds[i]:bounds[i+1]].
    """
    if not len(words):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    grams = _Grams(words, bounds)
    none = np.zeros(0, np.int64)
    starts, ends, periods = [none], [none], [none]

    def keep(a: np.ndarray, b: np.ndarray, q: np.ndarray) -> None:
        ok = b - a >= np.maximum(least, 2 * q)
        starts.append(a[ok])
        ends.append(b[ok])
        periods.append(q[ok])

    single = grams.names[0]
    for q in range(1, min(LAGS, len(words))):
        a, b = _stretches((single[:-q] == single[q:]) & (single[:-q] >= 0))
        keep(a, b + q, np.full(len(a), q))
    scale = LAGS
    while len(grams.names) > (scale // 2).bit_length() - 1:
        x, q = _seeds(grams, scale)
        if len(x):
            keep(x - grams.match_before(x, x + q), x + q + grams.match_after(x, x + q), q)
        scale *= 2
    a, b, q = (np.concatenate(c) for c in (starts, ends, periods))
    order = np.lexsort((q, b, a))
    a, b, q = a[order], b[order], q[order]
    smallest = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
    a, b, q = a[smallest], b[smallest], q[smallest]
    order = np.lexsort((q, a))
    a, b, q = a[order], b[order], q[order]
    row = np.searchsorted(bounds, a, side="right") - 1
    return row, a - bounds[row], b - a, q


def kept_words(bounds: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each word stays: all but those that a run holds after its first period."""
    depth = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(depth, bounds[row] + start + period, 1)
    np.add.at(depth, bounds[row] + start + length, -1)
    return np.cumsum(depth)[:-1] == 0


RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def detect(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 12,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """(id_col, n_words, runs, collapsed) of every row.

    ``runs`` is an array of (start, length, period), ``collapsed`` the text
    with every run cut down to its first period, words joined by one space.
    ``rewrite`` is applied to each row's id and words before the search.
    """
    schema = T.StructType([
        docs.schema[id_col],
        T.StructField("n_words", T.LongType(), False),
        T.StructField("runs", T.ArrayType(RUN, False), False),
        T.StructField("collapsed", T.StringType(), False),
    ])

    def search(raw: list[bytes], ids: list) -> tuple[list[int], pa.Array, list[bytes]]:
        lists = [r.split() for r in raw]
        if rewrite is not None:
            lists = [rewrite(i, w) for i, w in zip(ids, lists, strict=True)]
        number: dict[bytes, int] = defaultdict(count().__next__)
        bounds = np.cumsum([0, *map(len, lists)])
        words = np.empty(bounds[-1], np.int64)
        for a, b, w in zip(bounds[:-1], bounds[1:], lists, strict=True):
            words[a:b] = np.fromiter(map(number.__getitem__, w), np.int64, len(w))
        row, start, length, period = runs_of(words, bounds, least)
        stays = kept_words(bounds, row, start, length, period)
        touched = set(row.tolist())
        texts = [
            b" ".join([x for x, s in zip(w, stays[a:b].tolist(), strict=True) if s] if i in touched else w)
            for i, (a, b, w) in enumerate(zip(bounds[:-1], bounds[1:], lists, strict=True))
        ]
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
        each = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (start, length, period)], names=["start", "length", "period"])
        return [len(w) for w in lists], pa.ListArray.from_arrays(pa.array(ends), each), texts

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column(1))
            for a, b in slices(offsets):
                raw = [data[x:y].tobytes() for x, y in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
                ids = batch.column(0).slice(a, b - a)
                n, runs, texts = search(raw, ids.to_pylist() if rewrite is not None else [])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), runs, pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(apply, schema)
