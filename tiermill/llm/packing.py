"""Packing of tokenized documents into sequences by first-fit decreasing.

Documents are tokenized (a map over the rows), an end id is added and the ids
are cut every ``capacity`` ids. The pieces, a few numbers each and no ids, are
dealt by a hash of document and place into randomised groups of a set size;
each group is packed on its own: pieces in decreasing length, each into the
first bin with room, found in a tournament tree of the bins' free capacities.
A group's size does not grow with the data, and a hot source or a very long
document spreads over all groups.

Words repeat, so each task keeps the ids of words it has met (a bounded table)
and asks the tokenizer only for new ones; the ids are the tokenizer's own.

Null and empty texts hold the end id alone. Repeated rows are documents of
their own, ties in length go by id, start and key, extra columns do not matter,
and an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import keep_table, with_key
from tiermill.session import cut_lineage


class WordEncoder:
    """Ids (little-endian unsigned 32-bit) of texts, for tokenizers that never join across white space.

    White space (space, tab, line ends) splits a text into chunks whose ids
    are remembered, at most ``remember`` of them. A chunk of plain letters and
    trailing punctuation is looked up as its lower-case letters and its
    punctuation, which the tokenizer splits as well; those are chunks too, in
    the same table.
    """

    _MARKS = ".,!?;:|%*&$#"
    _LATIN = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+")

    def __init__(self, path: str, remember: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.remember = remember
        self.known: dict[str, bytes] = {"": b""}
        # a plain word needs no splitting or composing: its bytes go to the tokenizer's model at once
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.as_symbols = {b: 256 + i for i, b in enumerate(others)}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        symbols = word.encode().decode("latin-1").translate(self.as_symbols)
        ids = [token.id for token in self.tokenizer.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, missing: set[str]) -> None:
        odd, known = [], self.known
        for chunk in missing:
            word = chunk.rstrip(self._MARKS)
            if not (word.isalpha() and (word.isascii() or self._LATIN.fullmatch(word))):
                odd.append(chunk)
                continue
            mark = chunk[len(word) :]
            if not word.islower():
                word = word.lower()
            ids = known.get(word)
            if ids is None:
                ids = known[word] = self._word(word)
            if mark:
                if mark not in known:
                    known[mark] = self._whole([mark])[0]
                known[chunk] = ids + known[mark]
            else:
                known[chunk] = ids
        if odd:
            known.update(zip(odd, self._whole(odd), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        known = self.known
        if len(known) > self.remember:
            known.clear()
            known[""] = b""
        missing = set().union(*split).difference(known)
        if missing:
            self._learn(missing)
        get = known.__getitem__
        return [b"".join(map(get, words)) for words in split]


#: Words that a task's table remembers, about 200 bytes each.
REMEMBER = 600_000

_ENCODERS: dict[tuple[str, int], WordEncoder] = {}
keep_table(_ENCODERS.clear)


def pieces(
    rows: DataFrame, tokenizer_path: str, capacity: int, end_id: int, batch_chars: int = 1 << 20, remember: int = REMEMBER
) -> DataFrame:
    """(key, id, start, length, ids_crc32, doc_tokens) of every piece of (key, id, text) rows."""
    schema = "key long, id long, start long, length long, ids_crc32 long, doc_tokens long"
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get((tokenizer_path, remember)) or WordEncoder(tokenizer_path, remember)
        _ENCODERS[tokenizer_path, remember] = encoder
        for batch in batches:
            keys, ids = batch.column("key").to_pylist(), batch.column("id").to_pylist()
            texts = batch.column("text")
            out: list[tuple] = []
            a = 0
            while a < batch.num_rows:
                part, size, b = [], 0, a
                while b < batch.num_rows and (b == a or size < batch_chars):
                    part.append(texts[b].as_py() or "")
                    size += len(part[-1])
                    b += 1
                for i, raw in zip(range(a, b), encoder.encode(part), strict=True):
                    raw += end
                    total = len(raw) // 4
                    for start in range(0, total, capacity):
                        piece = raw[4 * start : 4 * (start + capacity)]
                        out.append((keys[i], ids[i], start, len(piece) // 4, zlib.crc32(piece), total))
                a = b
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["key", "id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return rows.select("key", "id", "text").mapInArrow(cut, schema)


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each length, taken in the given order, by a tournament tree.

    The leaves hold the bins' free room, an inner node the larger of its two;
    going down to the left wherever there is room finds the first bin that
    fits in logarithmic time.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - tree[node])
        tree[node] -= n
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 2,
    group_bins: int = 512,
    remember: int = REMEMBER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    A task's table of words holds ``remember``: fewer take more time and less
    memory. A group holds about ``group_bins`` sequences. Sequence ids are unique and
    not gapless: the group's number times 2**20, plus the bin's.
    """
    cut = cut_lineage(pieces(with_key(docs, id_col, text_col), tokenizer_path, capacity, end_id, remember=remember))
    total = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (capacity * group_bins)))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("key", "start"), F.lit(groups)))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

    def fill(table: pa.Table) -> pa.Table:
        column = {c: table.column(c).to_numpy() for c in ("length", "start", "key")}
        ids = table.column("id").fill_null(0).to_numpy()
        order = np.lexsort((column["key"], column["start"], ids, table.column("id").is_null().to_numpy(), -column["length"]))
        bins, offsets = first_fit(column["length"][order].tolist(), capacity)
        out = table.take(pa.array(order))
        sequence = out.column("group").to_numpy() * (1 << 20) + np.array(bins, np.int64)
        return pa.Table.from_arrays(
            [*[out.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")],
             pa.array(sequence.astype(np.int64)), pa.array(offsets, pa.int64())],
            names=[c.split()[0] for c in schema.split(", ")])

    return dealt.groupBy("group").applyInArrow(fill, schema).withColumnRenamed("id", id_col)
