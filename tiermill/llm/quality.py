"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated.

Each hashed word has a sparse random index vector; its word vector is the sum
of the index vectors of the words around it in the fitting sample (random
indexing), scaled to unit length, with its own index vector mixed in. A word
counts three times: as its lower-case letters, as its shape (runs of letter
case, digits and each other sign) and as the distance back to the same word in
the text, so that layout, noise and repetition have vectors as words do. A
document is the mean of its vectors, drawn towards zero for a few words, with
the logarithm of its length. A two-layer network (tanh, then a
logistic output) is trained on these means by Adam in numpy, and its
probability is calibrated by a temperature on texts kept out of the training.

The fitting sample is bounded by parameters; scoring is a map over the rows,
without a shuffle. Null and empty texts have the mean vector zero and get the
network's answer to it. Repeated rows, ties, nulls in other columns and extra
columns do not matter; an empty table gives an empty result. Without two
classes of labelled texts every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import ascii_lower, group_sums, mix64, slices, span_hashes, utf8_view, word_spans
from tiermill.llm.langid import sample_per_class

WORDS = 1 << 14
SHAPES = 1 << 11
GAPS = 16
#: Words that a document of no content is deemed to hold besides its own.
_PRIOR = 4

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = 97
_CLASS[65:91] = 65
_CLASS[48:58] = 48
_CLASS[128:] = 97


def _distance_back(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of the distance back to the same word of the row (0: there is none)."""
    out = np.zeros(len(words), np.int64)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        order = np.argsort(words[a:b], kind="stable")
        same = np.flatnonzero(words[a:b][order][1:] == words[a:b][order][:-1])
        out[a + order[same + 1]] = 1 + np.log2(order[same + 1] - order[same]).astype(np.int64)
    return np.minimum(out, GAPS - 1)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, shape bucket, distance bucket, words before each row)."""
    starts, ends, bounds = word_spans(data, offsets)
    words = span_hashes(ascii_lower(data), starts, ends)
    kind = _CLASS[data]
    turn = np.ones(len(data), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[starts] = True
    at = np.flatnonzero(turn)
    shapes = span_hashes(kind[at], np.searchsorted(at, starts), np.searchsorted(at, ends))
    return (
        (words % np.uint64(WORDS)).astype(np.int64), (shapes % np.uint64(SHAPES)).astype(np.int64),
        _distance_back(words, bounds), bounds,
    )


def index_vectors(n: int, dim: int, seed: int, nonzero: int = 6) -> np.ndarray:
    """Sparse ternary random vectors, one per bucket."""
    out = np.zeros((n, dim), np.float32)
    base = np.arange(n, dtype=np.uint64) * np.uint64(64) + np.uint64(seed * 1_000_003)
    for j in range(nonzero):
        h = mix64(base + np.uint64(j))
        out[np.arange(n), (h % np.uint64(dim)).astype(np.int64)] += np.where(h >> np.uint64(63), 1, -1)
    return out


@dataclass(frozen=True)
class QualityModel:
    words: np.ndarray
    shapes: np.ndarray
    layers: list[np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    temperature: float
    constant: float | None = None

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return _pooled(self.words, self.shapes, data, offsets)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        x = (self.features(data, offsets) - self.mean) / self.scale
        return _sigmoid(_forward(x, self.layers)[1] / self.temperature)


def _pooled(words, shapes, data, offsets) -> np.ndarray:
    w, s, g, bounds = _tokens(data, offsets)
    n = np.diff(bounds)
    total = [group_sums(words[w], bounds), group_sums(shapes[s], bounds), group_sums(np.eye(GAPS, dtype=np.float32)[g], bounds)]
    return np.hstack([np.hstack(total) / (n + _PRIOR)[:, None], np.log1p(n)[:, None] / 4])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _forward(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2


def _word_vectors(w: np.ndarray, bounds: np.ndarray, size: int, dim: int, seed: int, window: int) -> np.ndarray:
    index = index_vectors(size, dim, seed)
    context = np.zeros((size, dim), np.float32)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for d in range(1, window + 1):
        same = np.flatnonzero(row[d:] == row[:-d])
        for a in range(0, len(same), 1 << 18):  # in parts, for memory
            i = same[a : a + (1 << 18)]
            np.add.at(context, w[i], index[w[i + d]])
            np.add.at(context, w[i + d], index[w[i]])
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    return (context / np.maximum(norm, 1e-6) + 0.5 * index / np.sqrt(6)).astype(np.float32)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 1500,
    max_text_bytes: int = 1 << 15,
    dim: int = 32,
    window: int = 2,
    hidden: int = 32,
    epochs: int = 60,
    seed: int = 11,
) -> QualityModel:
    """Fit on about ``per_class`` labelled texts of each class, of at most ``max_text_bytes``.

    Nothing else comes to the driver. ``labels`` holds the rows to learn from;
    several labels of one id count as their maximum.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    drawn = sample_per_class(known, "id", F.col("y"), per_class, 2 * per_class, seed).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.octet_length("text") <= max_text_bytes)
    got = sorted((r["id"], r["label"], r["text"]) for r in texts.join(F.broadcast(drawn), "id").select("id", "label", "text").collect())
    y = np.array([r[1] for r in got], np.float32)
    if len(set(y)) < 2:
        zero = np.zeros((1, 1), np.float32)
        return QualityModel(zero, zero, [], zero, zero, 1.0, float(y.mean()) if len(y) else 0.5)
    raw = [r[2].encode() for r in got]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    parts = [(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
    tokens = [_tokens(*p) for p in parts]
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(t[3]) for t in tokens]))])
    words = _word_vectors(np.concatenate([t[0] for t in tokens]), bounds, WORDS, dim, seed, window)
    shapes = _word_vectors(np.concatenate([t[1] for t in tokens]), bounds, SHAPES, dim, seed + 1, window)
    x = np.vstack([_pooled(words, shapes, *p) for p in parts])
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 0
    mean, scale = x[~held].mean(axis=0), x[~held].std(axis=0) + 1e-3
    x = (x - mean) / scale
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    train, step = np.flatnonzero(~held), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
            h, z = _forward(x[part], layers)
            g = (_sigmoid(z) - y[part]) / len(part)
            back = np.outer(g, layers[2]) * (1 - h**2)
            grads = [x[part].T @ back + 2e-3 * layers[0], back.sum(0), h.T @ g + 2e-3 * layers[2], np.array([g.sum()])]
            step += 1
            for k, d in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                layers[k] = layers[k] - 3e-3 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    z, t = _forward(x[held], layers)[1], y[held]
    losses = []
    for temperature in np.geomspace(0.3, 10, 60):
        p = np.clip(_sigmoid(z / temperature), 1e-9, 1 - 1e-9)
        losses.append((-(t * np.log(p) + (1 - t) * np.log(1 - p)).mean(), temperature))
    return QualityModel(words, shapes, layers, mean, scale, float(min(losses)[1]) if len(z) else 1.0)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row of ``docs``; ``model`` has ``scores(bytes, offsets)``."""
    cols = docs.select(id_col, F.col(text_col).alias("_text"))
    schema = cols.drop("_text").schema.add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_view(batch.column("_text"))
            out = np.zeros(batch.num_rows)
            for a, b in slices(offsets):
                out[a:b] = model.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=schema.names)

    return cols.mapInArrow(apply, schema)
