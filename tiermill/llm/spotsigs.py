"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Words are runs of ASCII letters and digits and of all non-ASCII bytes, without
ASCII case. Every common word is an anchor; its signature is the anchor with the
next ``CHAIN`` words that are not common, hashed to 32 bits. A document's
fingerprint is the set of its signatures, written as base64 of the sorted
little-endian 32-bit numbers. A text with words but without a whole chain has
one signature made of all its words; a text without words (null and empty
texts, too) has the empty fingerprint.

Likeness is the Jaccard index of two sets; two empty sets are alike (1.0).
:func:`pruned_jaccard` leaves a pair whose lengths or whose remaining elements
cannot reach a threshold. :func:`length_class` numbers ranges of set lengths
such that sets of a Jaccard index of the threshold or more lie in the same or
in neighbouring ranges.

Repeated rows are rows of their own, ties in the id go by text, null ids come
first, extra columns do not matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import SLICE_BYTES, ascii_lower, distinct_by_row, mix64, shuffle_width, span_hashes

#: Common words of English, German, French and Spanish.
ANCHORS = tuple(
    "a an and are as at be by for from in is it of on or that the this to was with "
    "als auch auf aus bei das dem den der die ein eine einen im ist mit nicht sich und von zu "
    "au aux avec ce dans de des du en est et il la le les ne par pas pour que qui se sur un une "
    "al como con del el es las lo los más no para por sin su una y".split()
)
CHAIN = 3

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def _hash_words(words: tuple[str, ...]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


def signatures(texts: list[bytes], anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted distinct signatures of each text."""
    out: list[np.ndarray] = []
    common = np.sort(_hash_words(anchors))
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= SLICE_BYTES):
            size += len(texts[b])
            b += 1
        out += _signatures(texts[a:b], common, chain)
        a = b
    return out


def _signatures(texts: list[bytes], common: np.ndarray, chain: int) -> list[np.ndarray]:
    # a line end between texts keeps their words apart
    data = ascii_lower(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    inside = np.concatenate([[False], _WORD[data], [False]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    words = span_hashes(data, turn[::2], turn[1::2])
    row = np.searchsorted(offsets, turn[::2], side="right") - 1
    place = np.searchsorted(common, words)
    is_anchor = common[np.minimum(place, len(common) - 1)] == words
    content, owner = words[~is_anchor], row[~is_anchor]
    anchor, before = row[is_anchor], np.cumsum(~is_anchor)[is_anchor]
    last = before + chain - 1
    whole = last < len(content)
    whole[whole] &= owner[last[whole]] == anchor[whole]
    sig = mix64(words[is_anchor][whole])
    for j in range(chain):
        sig = mix64(sig * np.uint64(0x9E3779B97F4A7C15) + content[before[whole] + j])
    row_of, value = anchor[whole], sig >> np.uint64(32)
    # texts without a chain: one signature of all words
    bare = np.setdiff1d(np.unique(row), row_of)
    if len(bare):
        mine = np.isin(row, bare)
        at = np.flatnonzero(np.concatenate([[True], row[mine][1:] != row[mine][:-1]]))
        nth = np.arange(mine.sum()) - np.repeat(at, np.diff(np.append(at, mine.sum())))
        total = np.add.reduceat(mix64(words[mine] + mix64(nth.astype(np.uint64))), at)
        row_of = np.concatenate([row_of, bare])
        value = np.concatenate([value, mix64(total) >> np.uint64(32)])
        order = np.argsort(row_of, kind="stable")
        row_of, value = row_of[order], value[order]
    row_of, value = distinct_by_row(row_of, value)
    return np.split(value.astype("<u4"), np.searchsorted(row_of, np.arange(1, len(texts))))


def fingerprint_text(signature_set: np.ndarray) -> str:
    return base64.b64encode(signature_set.astype("<u4").tobytes()).decode()


def read_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def pruned_jaccard(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard index of two sorted sets; 0.0 at once where it cannot reach ``threshold``."""
    if not len(a) and not len(b):
        return 1.0
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < threshold * len(large) or not len(small) or small[-1] < large[0] or large[-1] < small[0]:
        return 0.0
    at = np.searchsorted(large, small)
    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    value = shared / (len(a) + len(b) - shared)
    return value if value >= threshold else 0.0


def length_class(length: Column, threshold: float = 0.8) -> Column:
    """Number of the range of set lengths: range k begins at about threshold ** -k."""
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / -math.log(threshold)).cast("int")


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _bucket(key: Column, bounds: list[int], lo: int = 0, hi: int | None = None) -> Column:
    """The number of bounds below ``key``, by a tree of comparisons."""
    hi = len(bounds) if hi is None else hi
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key <= F.lit(bounds[mid]), _bucket(key, bounds, lo, mid)).otherwise(_bucket(key, bounds, mid + 1, hi))


def fingerprint_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN, spread: int = 4,
) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next row's.

    The next row is that of the next id (after the last, the first). Rows are
    dealt out by ranges of the id, ``spread`` ranges for each shuffle
    partition; the first row of each range goes to the range before as well.
    One shuffle of the texts; only the ranges' bounds and first ids, a few
    numbers for each range, come to the driver. A range is read row by row.
    """
    lowest = F.lit(-(2**63))
    rows = docs.select(
        docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"),
        F.coalesce(docs[id_col].cast("long"), lowest).alias("k"),
    )
    n = spread * shuffle_width(docs.sparkSession)
    keys = rows.select("k")
    got = keys.select(F.approx_percentile("k", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(20 * n))).first()[0]
    bounds = sorted(set(got or []))
    bucket = _bucket(F.col("k"), bounds)
    first = {r["b"]: r["k"] for r in keys.groupBy(bucket.alias("b")).agg(F.min("k").alias("k")).collect()}
    order = sorted(first)
    before = {first[b]: order[i - 1] for i, b in enumerate(order)}  # the lowest goes to the last range
    copies = F.array(F.struct(bucket.alias("b"), F.lit(0).alias("late")))
    if before:
        also = _lookup(F.col("k"), sorted(before.items()))
        copies = F.when(
            F.col("k").isin(list(before)),
            F.concat(copies, F.array(F.struct(also.alias("b"), F.lit(1).alias("late")))),
        ).otherwise(copies)
    dealt = rows.withColumn("to", F.explode(copies)).select("to.b", "to.late", "k", "id", "text")
    dealt = dealt.repartition("b").sortWithinPartitions("b", "late", "k", "text")
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, n_signatures long"
    )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # the row that waits for its next
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("b", "late", "id")]
            places, late, ids = (c.to_pylist() for c in columns)
            texts = batch.column(batch.schema.get_field_index("text"))
            a = 0
            while a < batch.num_rows:
                todo, size = [], 0
                while a < batch.num_rows and size < SLICE_BYTES:
                    here = (places[a], ids[a], texts[a].as_py())
                    if last is not None and last[0] == here[0]:
                        todo.append((last[1], last[2], here[2]))
                        size += len(here[2])
                    last = None if late[a] else here
                    a += 1
                if todo:
                    yield _fingerprint_rows(todo, anchors, chain)

    return dealt.mapInArrow(apply, schema).withColumnRenamed("id", id_col)


def _lookup(key: Column, pairs: list[tuple[int, int]]) -> Column:
    """The value for ``key`` among sorted (key, value) pairs, by a tree of comparisons."""
    if len(pairs) == 1:
        return F.lit(pairs[0][1])
    mid = len(pairs) // 2
    return F.when(key < F.lit(pairs[mid][0]), _lookup(key, pairs[:mid])).otherwise(_lookup(key, pairs[mid:]))


def _fingerprint_rows(todo: list[tuple[int, str, str]], anchors: tuple[str, ...], chain: int) -> pa.RecordBatch:
    """Result rows of (id, text, next text) triples; each row's next is the following row but for the last."""
    edited = [edit(text, following) for _, text, following in todo]
    raw = [text.encode() for _, text, _ in todo]
    raw_edited = [e.encode() for e in edited]
    found = signatures([*raw, *raw_edited, todo[-1][2].encode()], anchors, chain)
    n = len(todo)
    own, changed = found[:n], found[n : 2 * n]
    following = [own[i + 1] if i + 1 < n and todo[i + 1][1] == todo[i][2] else None for i in range(n)]
    following[-1] = found[-1]
    for i in range(n):
        if following[i] is None:
            following[i] = signatures([todo[i][2].encode()], anchors, chain)[0]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([t[0] for t in todo], pa.int64()),
            pa.array([len(t[1]) for t in todo], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in raw_edited]),
            pa.array([fingerprint_text(s) for s in own]),
            pa.array([fingerprint_text(s) for s in changed]),
            pa.array([pruned_jaccard(x, y) for x, y in zip(own, changed, strict=True)]),
            pa.array([pruned_jaccard(x, y) for x, y in zip(own, following, strict=True)]),
            pa.array([len(s) for s in own], pa.int64()),
        ],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
               "n_signatures"],
    )
