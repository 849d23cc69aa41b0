"""Language identification from averaged hashed subword embeddings.

A text is the average of the embeddings of its hashed byte n-grams (one to
four bytes that start inside a word), followed by a linear softmax. Both are
trained together by stochastic gradient descent in numpy on the driver, from a
sample of labelled texts whose size is bounded by parameters. The softmax is
calibrated by a temperature on texts kept out of the training, and so is the
probability below which a prediction is rejected.

After training, embedding and softmax are multiplied into one table of a few
hundred KB (a row of logits per bucket), so that a text is scored by looking
its n-grams up: a map over the rows, without a shuffle.

Null and empty texts, and texts without a letter, give ``und`` with score 0.
Nulls in other columns, repeated rows and extra columns do not matter; an
empty table gives an empty result. Without a labelled text the model knows no
language and answers ``und`` throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import group_sums, release_tables, sendable, slices, utf8_view
from tiermill.session import cut_lineage

UNDETERMINED = "und"
#: Bytes of text scored at once: each letter has a row of logits for each of four n-grams, some 100 bytes a byte of text.
SCORED_BYTES = 1 << 18
BUCKETS = 1 << 15
_SIZES = (1, 2, 3, 4)
_ODD = np.array([0x01000193, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)

#: Byte classes: lower-case letters, bytes of longer UTF-8 sequences as they are, all else a space.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _fold(data: np.ndarray) -> np.ndarray:
    out = _FOLD[data]
    if len(data) > 1:  # capitals of Latin-1 letters
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def _ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, n-grams before each row): the n-grams of all sizes that begin at each letter.

    An n-gram that would leave its row or go past the space after its word
    is filled up with spaces.
    """
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    c = _fold(data)
    inside = c != 32
    end = np.zeros(len(c) + 1, bool)
    end[offsets[1:]] = True
    at = np.flatnonzero(inside)
    open_ = np.ones(len(at), bool)  # the word goes on
    h = np.zeros(len(at), np.uint32)
    padded = np.concatenate([c, np.full(len(_SIZES), 32, np.uint8)])
    stop = np.concatenate([end, np.ones(len(_SIZES), bool)])
    out = np.empty((len(at), len(_SIZES)), np.int32)
    for j, n in enumerate(_SIZES):
        byte = np.where(open_, padded[at + j], 32).astype(np.uint32)
        h = (h ^ (byte + np.uint32(1))) * _ODD[j]
        h ^= h >> np.uint32(15)
        out[:, j] = (h ^ np.uint32(n * 0x9E37)) & np.uint32(BUCKETS - 1)
        open_ &= (byte != 32) & ~stop[at + j + 1]
    return out.ravel(), np.searchsorted(at, offsets) * len(_SIZES)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    """``table``: logits per bucket; ``floor``: probability below which a prediction is rejected."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    floor: float

    def probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        grams, bounds = _ngrams(data, offsets)
        total = group_sums(self.table[grams], bounds)
        mean = total / np.maximum(np.diff(bounds), 1)[:, None]
        return _softmax((mean + self.bias) / self.temperature)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.zeros(256, np.int64)
    ascii_letters[65:91] = ascii_letters[97:123] = 1
    found = group_sums(ascii_letters[data], offsets) > 0
    for i in np.flatnonzero(~found):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(ch.isalpha() for ch in text)
    return found


def sample_per_class(
    rows: DataFrame, id_col: str, label: Column, per_class: int, max_rows: int, seed: int
) -> DataFrame:
    """About ``per_class`` rows of each label, by a hash of the id: the same rows each time.

    Rare labels keep all their rows. With many labels each has fewer rows, so
    that all together have about ``max_rows`` (or one a label); no label is
    left out.
    """
    labelled = rows.withColumn("label", label)
    counts = labelled.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("_count"))
    labels = counts.count()
    if not labels:
        return labelled.where(F.lit(False))
    scale = 1_000_000
    wanted = max(1, min(per_class, max_rows // labels))
    share = counts.select("label", F.least(F.lit(scale), F.ceil(F.lit(wanted * scale) / F.col("_count"))).alias("_share"))
    drawn = labelled.join(sendable(cut_lineage(share)), "label").where(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(scale)) < F.col("_share"))
    return drawn.select(*labelled.columns)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = 800,
    max_texts: int = 51_200,
    max_text_bytes: int = 1 << 16,
    segment_bytes: int = 240,
    max_segments: int = 16_000,
    dim: int = 16,
    epochs: int = 4,
    rate: float = 0.5,
    reject_share: float = 0.0005,
    seed: int = 7,
) -> LanguageModel:
    """Train on about ``per_lang`` texts of each language (texts of at most ``max_text_bytes``).

    The sample, at most ``max_texts`` texts and a little (or one a language), is
    all that comes to the driver; every language in it is learned. Training samples are pieces of ``segment_bytes``
    of its texts, so that short texts are met too. One text in five calibrates.
    """
    rows = labelled.select(id_col, text_col, lang_col).where(
        F.col(text_col).isNotNull() & (F.octet_length(text_col) <= max_text_bytes)
    )
    drawn = sample_per_class(rows, id_col, F.col(lang_col), per_lang, max_texts, seed)
    got = sorted((r["label"], r[text_col]) for r in drawn.select("label", text_col).collect())
    langs = sorted({lang for lang, _ in got})
    if not langs:
        return LanguageModel([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    pieces, labels, held = [], [], []
    for i, (lang, text) in enumerate(got):
        raw = text.encode()
        for a in range(0, max(1, len(raw) - segment_bytes // 2), segment_bytes):
            piece = raw[a : a + segment_bytes]
            pieces.append(piece[: int(rng.integers(20, segment_bytes + 1))] if rng.random() < 0.3 else piece)
            labels.append(langs.index(lang))
            held.append(i % 5 == 0)
    pick = rng.permutation(len(pieces))[:max_segments]
    held, y = np.array(held)[pick], np.array(labels)[pick]
    data = np.frombuffer(b"".join(pieces[i] for i in pick), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(pieces[i]) for i in pick])])
    grams, bounds = _ngrams(data, offsets)
    emb = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    soft = np.zeros((dim, len(langs)), np.float32)
    soft[:] = rng.normal(0, 0.1, soft.shape)
    weight = 1.0 / np.maximum(np.bincount(y[~held], minlength=len(langs)), 1)
    weight = weight / weight.mean()
    train = np.flatnonzero(~held & (np.diff(bounds) > 0))
    for epoch in range(epochs):
        step = rate * 20 * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
            if not len(part):
                continue
            n = np.diff(bounds)[part]
            at = np.repeat(bounds[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            g = grams[at]
            mean = np.add.reduceat(emb[g], np.cumsum(n) - n, axis=0) / n[:, None]
            p = _softmax(mean @ soft)
            p[np.arange(len(part)), y[part]] -= 1
            p *= (weight[y[part]] / len(part))[:, None]
            back = (p @ soft.T) / n[:, None]
            soft -= step * 0.05 * (mean.T @ p)
            np.subtract.at(emb, g, (step * 20 * np.repeat(back, n, axis=0)).astype(np.float32))
    table = emb @ soft
    raw = LanguageModel(langs, table, np.zeros(len(langs), np.float32), 1.0, 0.0)
    z = np.log(np.maximum(raw.probabilities(data, offsets), 1e-12))[held]
    temperature, floor = 1.0, 0.0
    if len(z):
        losses = [(-np.log(_softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean(), t)
                  for t in np.geomspace(0.05, 5, 60)]
        temperature = float(min(losses)[1])
        # pieces are shorter than texts and so less sure: the floor spares whole texts
        floor = float(np.quantile(_softmax(z / temperature).max(axis=1), reject_share))
    return LanguageModel(langs, table, raw.bias, temperature, min(floor, 0.6))


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_col, lang_pred, score, rejected) of each row of ``docs``.

    ``lang_pred`` is the likeliest language, also of a rejected text, but
    ``und`` (score 0, rejected) for a text without a letter. ``rejected`` is
    set where the calibrated probability is under the model's floor.
    """
    cols = docs.select(id_col, F.col(text_col).alias("_text"))
    schema = cols.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    names = np.array([*model.langs, UNDETERMINED], dtype=object)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column("_text"))
            best = np.full(batch.num_rows, len(model.langs))
            prob = np.zeros(batch.num_rows)
            for a, b in slices(offsets, SCORED_BYTES) if model.langs else ():
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                p = model.probabilities(part, off)
                found = has_letter(part, off)
                best[a:b] = np.where(found, p.argmax(axis=1), len(model.langs))
                prob[a:b] = np.where(found, p.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(prob, pa.float64()),
                 pa.array((best == len(model.langs)) | (prob < model.floor))],
                names=schema.names,
            )

    return cols.mapInArrow(score, schema)


def accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language the model does not reject, as they are."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_tables()
        for batch in batches:
            data, offsets = utf8_view(batch.column(0).field(text_col))
            keep = np.zeros(batch.num_rows, bool)
            for a, b in slices(offsets, SCORED_BYTES) if model.langs else ():
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                keep[a:b] = has_letter(part, off) & (model.probabilities(part, off).max(axis=1) >= model.floor)
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(sift, rows.schema).select("row.*")
