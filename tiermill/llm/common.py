"""Helpers the operators share: byte views of Arrow text, hashing, row numbering.

Everything that touches text works on the UTF-8 bytes of an Arrow batch with
numpy, in slices of a bounded number of bytes (a single longer text is a slice
of its own), so a task's memory follows the slice, not the partition.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.session import cut_lineage

#: Bytes of text that numpy works on at once.
SLICE_BYTES = 1 << 20

_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(id_col: str | Column) -> Column:
    """Unsigned CRC-32 of the id written as text (null id: of the empty text)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "UTF-8"))


# -- bytes ---------------------------------------------------------------


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as an empty text."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)
    off = off[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of at most ``limit`` bytes, or of one longer text."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


@dataclass
class _Powers:
    up: np.ndarray
    down: np.ndarray


_POWERS = _Powers(np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers(n: int) -> _Powers:
    """Powers of the multiplier and of its inverse, modulo 2**64, at least n of them."""
    if len(_POWERS.up) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _MULT), ("down", _INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            setattr(_POWERS, name, np.multiply.accumulate(p))
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (splitmix finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each data[start:end], equal for equal bytes (and lengths)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    p = _powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p.up[: len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * p.down[starts])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each row) of the runs without white space.

    A run never crosses a row's border. The third array has one entry more
    than there are rows.
    """
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | border[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | border[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_shingles(
    words: np.ndarray, bounds: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``k`` words; a shorter row's whole sequence is one.

    ``words`` are word hashes, ``bounds`` the words before each row. Rows
    without words have none.
    """
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + bounds[:-1][row]
    length = np.minimum(n[row], k)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    h = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(k):
        odd = np.uint64((_MULT * (2 * j + 3) | 1) & (2**64 - 1))
        h = h + np.where(j < length, mix64(padded[at + j] + odd), np.uint64(0)) * odd
    return row, mix64(h)


def distinct_by_row(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs, sorted by row and hash; ``row`` must be ascending."""
    if not len(row):
        return row, h
    h = h.copy()
    for part in np.split(h, np.flatnonzero(row[1:] != row[:-1]) + 1):
        part.sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[keep], h[keep]


def group_sums(values: np.ndarray, bounds: np.ndarray, op=np.add, empty=0) -> np.ndarray:
    """``op`` over values[bounds[i]:bounds[i+1]] for each i; ``empty`` where that is empty."""
    n = np.diff(bounds)
    out = np.full((len(n), *values.shape[1:]), empty, values.dtype)
    full = n > 0
    if full.any():
        out[full] = op.reduceat(values, bounds[:-1][full], axis=0)
    return out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for each whole window, by block-wise running minima."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


#: Empties the tables that operators keep in a worker process from task to task.
_TABLES: list[Callable[[], None]] = []


def keep_table(clear: Callable[[], None]) -> None:
    """Registers a table that a worker process keeps from task to task."""
    _TABLES.append(clear)


def release_tables() -> None:
    """Empties them and gives freed memory back to the system; for tasks that need the memory and none of the tables."""
    for clear in _TABLES:
        clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:  # glibc
        trim(0)


# -- rows ----------------------------------------------------------------


def with_key(docs: DataFrame, id_col: str, text_col: str, rest: bool = False) -> DataFrame:
    """(key, id, text) and, if asked, ``rest``, a struct of all other columns.

    ``key`` tells rows apart, ``id`` is the caller's. Ids that are unique and
    not null are the keys themselves. Otherwise the rows are written once with
    a number each, so that repeated rows stay separate documents, and every
    later read sees the same numbers.
    """
    cols = [docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")]
    if rest:
        others = [docs[c] for c in docs.columns if c not in (id_col, text_col)]
        cols.append(F.struct(*others).alias("rest") if others else F.lit(None).cast("string").alias("rest"))
    rows = docs.select(*cols)
    seen = docs.select(docs[id_col].cast("long").alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")
    ).first()
    if seen["n"] == seen["d"]:
        return rows.select(F.col("id").alias("key"), "*")
    return cut_lineage(rows.select(F.monotonically_increasing_id().alias("key"), "*"))


def without_key(rows: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of :func:`with_key` (with ``rest``) as rows of ``docs`` again."""
    place = {id_col: F.col("id").cast(docs.schema[id_col].dataType), text_col: F.col("text")}
    return rows.select(*[(place[c] if c in place else F.col("rest")[c]).alias(c) for c in docs.columns])


#: A list of at most so many keys (8 bytes each) is sent to all tasks; a longer one is joined by a shuffle.
SEND_KEYS = 500_000


def sendable(keys: DataFrame) -> DataFrame:
    """A written list of keys, marked to be sent to all tasks if it is counted to be short enough."""
    return F.broadcast(keys) if keys.count() <= SEND_KEYS else keys


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def smallest_reachable(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that ``edges`` (a, b longs) lead to.

    Alternating star contraction: a large-star and a small-star step a round,
    each one shuffle of the remaining edges with the minimum taken before the
    shuffle, and each round written to the shared folder. Nothing but a count
    comes to the driver. The rounds grow with the logarithm of the longest
    chain; going past ``max_rounds`` raises.
    """
    edges = cut_lineage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = cut_lineage(
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = cut_lineage(
            large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.toDF("a", "b")).where("a <> b").distinct()
        )
        # done when every node hangs on a root that hangs on nothing
        deep = small.select("a").join(small.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        multi = small.groupBy("a").count().where("count > 1").limit(1).count()
        edges = small
        if not deep and not multi:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
