"""SentencePiece encoding and decoding through a table of distinct chunks.

A text is a row of chunks: runs of white-space markers, each with the word
after it. In a BPE model whose pieces never hold a marker behind another
character no merge crosses the start of a chunk, so the ids of a text are
those of its chunks one after the other. Each task keeps a table of distinct
chunks, has the library segment each new one once, and joins the ids back by
position. No text is shuffled: a table over the whole corpus would send every
occurrence of every word through the network twice to save each task its own
few thousand words.

Line ends part chunks as well if no piece holds one. What a model must have is
read from its file; a model without it (another normaliser, pieces across
markers, symbols set by a user, another algorithm) is asked for each whole text
instead, with the same results.

Decoding puts the pieces' bytes one after the other and leaves the marker that
encoding puts in front; ids in any unusual order (unknown ids, a first piece
without marker, bytes that are not UTF-8) go to the library as they are.

Null and empty texts hold the end id alone and decode to an empty text; null
ids stay null. Memory follows the longest text and a bounded table: texts are
taken in slices of ``SLICE_CHARS``, a longer one by itself, in parts that end
between chunks, and only its ids are held whole. Repeated rows and equal ids of
rows are rows of their own; there is no order, so ties do not arise. Extra
columns do not matter to ``encode`` and pass through ``decode``. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tiermill.llm.common import keep_table

#: Characters of text that are worked on at once.
SLICE_CHARS = 1 << 20
#: Characters that a task's table of chunks may hold.
TABLE_CHARS = 12 << 20

MARKER = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6
_BPE = 2


class Codec:
    """One model with its table of chunks."""

    def __init__(self, path: str, table_chars: int = TABLE_CHARS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        normal, kinds = spec.normalizer_spec, {p.type for p in spec.pieces}
        words = [p.piece for p in spec.pieces if p.type == _NORMAL]
        self.marker = self.model.piece_to_id(MARKER)
        self.by_chunks = (
            spec.trainer_spec.model_type == _BPE
            and not spec.trainer_spec.treat_whitespace_as_suffix
            and normal.add_dummy_prefix and normal.escape_whitespaces
            and not normal.remove_extra_whitespaces and not normal.precompiled_charsmap
            and kinds <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
            and MARKER in words
            and not any(MARKER in w.lstrip(MARKER) for w in words)
        )
        self.by_lines = self.by_chunks and not any("\n" in w for w in words)
        self.end = self.model.eos_id()
        if self.end < 0:
            raise ValueError(f"{path} has no end id")
        self.table: dict[str, bytes] = {}
        self.held, self.table_chars = 0, table_chars
        self.bytes_of = [
            b"" if p.type == _CONTROL else bytes([int(p.piece[3:-1], 16)]) if p.type == _BYTE
            else p.piece.replace(MARKER, " ").encode()
            for p in spec.pieces
        ]
        self.plain_start = frozenset(i for i, p in enumerate(spec.pieces) if p.type == _NORMAL and p.piece[0] == MARKER)
        self.odd = frozenset(i for i, p in enumerate(spec.pieces) if p.type == _UNKNOWN)

    # -- encoding --------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, each without its first marker; one that starts with a line end has no marker."""
        if not text:
            return []
        text = text.replace(MARKER, " ")
        if self.by_lines:
            text = text.replace("\n", " \n")
        words = text.split(" ")
        if "" not in words:
            return words
        out, markers = [], 0
        for word in words:
            if not word:
                markers += 1
            elif self.by_lines and word[0] == "\n":
                if markers:
                    out.append(" " * (markers - 1))
                out.append(word)
                markers = 0
            else:
                out.append(" " * markers + word)
                markers = 0
        if markers:
            out.append(" " * (markers - 1))
        return out

    def _learn(self, missing: list[str]) -> None:
        for chunk, ids in zip(missing, self.model.encode(missing, num_threads=1), strict=True):
            if not chunk:
                ids = [self.marker]
            elif self.by_lines and chunk[0] == "\n":
                ids = ids[1:]  # the library's own marker
            self.table[chunk] = np.array(ids, "<i4").tobytes()
            self.held += len(chunk) + 40

    def _ids_of_chunks(self, chunks: list[list[str]]) -> list[bytes]:
        if self.held > self.table_chars:
            self.table.clear()
            self.held = 0
        missing = set().union(*chunks).difference(self.table)
        if missing:
            self._learn(list(missing))
        get = self.table.__getitem__
        return [b"".join(map(get, c)) for c in chunks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian 32-bit, without the end id."""
        if not self.by_chunks:
            return [np.array(ids, "<i4").tobytes() for ids in self.model.encode(texts, num_threads=1)]
        if len(texts) == 1 and len(texts[0]) > 2 * SLICE_CHARS:
            return [b"".join(self._ids_of_chunks([self.chunks_between(texts[0], a, b)])[0] for a, b in parts(texts[0]))]
        return self._ids_of_chunks([self.chunks(t) for t in texts])

    def chunks_between(self, text: str, a: int, b: int) -> list[str]:
        """The chunks of text[a:b], which starts with its marker unless it is the text's start."""
        return self.chunks(text[a + 1 : b]) if a and b > a + 1 else [""] if a else self.chunks(text[:b])

    # -- decoding --------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text that the library's ``decode`` gives."""
        if not ids:
            return ""
        if ids[0] == self.end and len(ids) == 1:
            return ""
        if ids[0] in self.plain_start and self.odd.isdisjoint(ids):
            try:
                return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()
            except UnicodeDecodeError:
                pass
        return self.model.decode(ids)


def parts(text: str, size: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Places [a, b) of the parts of a text: each but the first starts with a marker that follows another character."""
    a = 0
    while a < len(text):
        b = min(len(text), a + size)
        while b < len(text) and not (text[b] in (" ", MARKER) and text[b - 1] not in (" ", MARKER)):
            b += 1
        yield a, b
        a = b


_CODECS: dict[str, Codec] = {}
keep_table(_CODECS.clear)


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _slices(sizes: list[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` characters, a longer row by itself."""
    a = total = 0
    for i, n in enumerate(sizes):
        if i > a and total + n > most:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(sizes):
        yield a, len(sizes)


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True
) -> DataFrame:
    """(id_col, ids array<int>) of every row: the library's ids, and the end id if asked."""
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        last = np.array([codec.end], "<i4").tobytes() if end else b""
        for batch in batches:
            texts = batch.column(1)
            sizes = [0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()]
            for a, b in _slices(sizes):
                found = codec.encode([t or "" for t in texts.slice(a, b - a).to_pylist()])
                ends = np.cumsum([0] + [(len(f) + len(last)) // 4 for f in found]).astype(np.int32)
                flat = np.frombuffer(b"".join([f + last for f in found]), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))],
                    names=[id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(apply, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids as ``out_col`` (which must be a new name)."""
    if out_col in encoded.columns:
        raise ValueError(f"{out_col} is a column already")
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])
    at = encoded.columns.index(ids_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            lists = batch.column(at)
            sizes = [0 if n is None else n for n in pa.compute.list_value_length(lists).to_pylist()]
            for a, b in _slices(sizes, SLICE_CHARS // 4):
                texts = [None if ids is None else codec.decode(ids) for ids in lists.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(a, b - a) for c in batch.columns], pa.array(texts, pa.string())], names=schema.names)

    return encoded.mapInArrow(apply, schema)
