"""Toxicity from a subsequence string kernel, Nystroem landmarks and a support vector machine.

The kernel counts the different subsequences of three characters that two
strings share, each weighted by ``DECAY`` to the power of the least span it
takes in either, so a string with a character put in stays near and one that
repeats itself comes no nearer. Spans reach five characters.
Letters count without case, digits that stand for a letter as that letter;
other signs are left out of a word, and single letters in a row are one word,
so that letters parted by signs or spaces are read as if they stood together.
A word's likeness to a landmark is a share of the landmark's likeness to
itself, less ``FLOOR`` (an ordinary word's chance likeness), zero below it and
one from ``RISE`` above it. A text scores as its worst word does.

Landmarks are the short strings that best tell labelled texts apart and are
not near one another. The Nystroem map (the inverse square root of the
landmarks' own kernel matrix) turns likenesses into features, a linear
squared-hinge machine separates the words of clean texts from those words of
toxic ones that hold a landmark and stand in no clean text, and Platt's
sigmoid, fitted on texts kept out that hold any likeness, gives the probability. Fitting uses a
sample bounded by parameters; scoring is a map over the rows, without a
shuffle. Words whose upper bound over all landmarks is below the floor are
passed over, which changes nothing.

Null and empty texts score as a text without any likeness. A very long text is
read as one slice of its own. Repeated rows, ties, nulls elsewhere and extra
columns do not matter; an empty table gives an empty result. Without two
classes of labels, or without a landmark, every score is label 1's share (0.5
if there are no labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.common import group_sums, span_hashes, word_spans
from tiermill.llm.langid import sample_per_class

DECAY = 0.7
FLOOR = 0.45
#: Likeness above the floor that counts in full: a string with one character put in reaches it.
RISE = 0.25
#: Least gain of a landmark, as a share of the best one's.
TELLING = 0.3
#: Least ratio of a landmark's shares among toxic and among clean texts.
PURE = 30
#: What a symbol more is worth to a landmark, as a share of its gain.
LONGER = 0.1
#: Landmarks are less alike than this.
APART = 0.4
#: Each part of the sample is scored by a machine that did not learn from it, for the sigmoid.
FOLDS = 5
#: Landmarks that share a bound.
_GROUP = 8
#: Places of the second and third character after the first.
_GAPS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_SIZE = 1 << 15

_SIGN = 31
_SYMBOL = np.full(256, _SIGN, np.int32)
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[128:] = 27 + np.arange(128) % 4
for _digit, _letter in zip("013457", "oieast", strict=True):
    _SYMBOL[ord(_digit)] = ord(_letter) - 96


@dataclass(frozen=True)
class Words:
    """Words as one array of symbols. ``left``: symbols up to the word's end; ``at``: where words begin."""

    symbols: np.ndarray
    left: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray) -> Words:
        at = np.concatenate([[0], np.cumsum(lengths)])
        return cls(symbols, np.repeat(at[1:], lengths) - np.arange(len(symbols)), at)

    def pick(self, which: np.ndarray) -> Words:
        n = np.diff(self.at)[which]
        places = np.repeat(self.at[:-1][which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return Words.of(self.symbols[places], n)

    def kernel(self, table: np.ndarray) -> np.ndarray:
        """For each word, the decayed sum of ``table`` over its distinct subsequences at their least span."""
        codes, spans = [], []
        word = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        for a, b in _GAPS:  # least spans first
            i = np.flatnonzero(self.left > b)
            feature = (self.symbols[i] << 10) + (self.symbols[i + a] << 5) + self.symbols[i + b]
            codes.append(word[i] * _SIZE + feature)
            spans.append(np.full(len(i), b + 1))
        code, first = np.unique(np.concatenate(codes), return_index=True)
        weight = (DECAY ** np.concatenate(spans)[first]).astype(np.float32)
        weight = weight.reshape(-1, *[1] * (table.ndim - 1))
        return group_sums(weight * table[code % _SIZE], np.searchsorted(code // _SIZE, np.arange(len(self.at))))

    def sums(self, table: np.ndarray) -> np.ndarray:
        """For each word, the decayed sum of ``table`` over all its subsequences: no less than ``kernel``."""
        per = np.zeros((len(self.symbols), *table.shape[1:]), np.float32)
        for a, b in _GAPS:
            i = np.flatnonzero(self.left > b)
            feature = (self.symbols[i] << 10) + (self.symbols[i + a] << 5) + self.symbols[i + b]
            per[i] += np.float32(DECAY ** (b + 1)) * table[feature]
        return group_sums(per, self.at)


def _table(strings: list[np.ndarray]) -> np.ndarray:
    """The explicit kernel features of some strings, a column each."""
    out = np.zeros((_SIZE, len(strings)), np.float32)
    for j, s in enumerate(strings):
        for a, b in _GAPS:
            if len(s) > b:
                i = np.arange(len(s) - b)
                np.maximum.at(out[:, j], (s[i] << 10) + (s[i + a] << 5) + s[i + b], DECAY ** (b + 1))
    return out


def _read(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words without their signs, runs of single letters as one word, and where each text's words begin."""
    starts, ends, bounds = word_spans(data, offsets)
    n = ends - starts
    places = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())
    symbols = _SYMBOL[data[places]]
    kept = symbols != _SIGN
    n = group_sums(kept.astype(np.int64), np.concatenate([[0], np.cumsum(n)]))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))[n > 0]
    n = n[n > 0]
    joined = np.concatenate([[False], (n[1:] == 1) & (n[:-1] == 1) & (text[1:] == text[:-1])]) if len(n) else np.zeros(0, bool)
    first = np.flatnonzero(~joined)
    lengths = np.diff(np.append(np.concatenate([[0], np.cumsum(n)])[first], n.sum()))
    return Words.of(symbols[kept], lengths), np.searchsorted(text[first], np.arange(len(offsets)))


@dataclass(frozen=True)
class Landmarks:
    """Kernel features of the landmarks (a column each), and their greatest by group and over all."""

    table: np.ndarray
    group: np.ndarray
    bound: np.ndarray

    @classmethod
    def of(cls, strings: list[np.ndarray]) -> Landmarks:
        table = _table(strings)
        table /= (table**2).sum(axis=0)  # a landmark's likeness to itself is 1
        group = np.stack([table[:, a : a + _GROUP].max(axis=1) for a in range(0, len(strings), _GROUP)], 1)
        return cls(table, group, table.max(axis=1))


def likeness(landmarks: Landmarks, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words near a landmark, for each its row, rows of likenesses to the landmarks), equal words in one row.

    A word is near where its bound, first over all landmarks and then over a
    group of them, reaches the floor.
    """
    near = np.flatnonzero(words.sums(landmarks.bound) >= FLOOR) if len(words.symbols) else np.zeros(0, int)
    code = span_hashes(words.symbols.astype(np.uint8), words.at[near], words.at[near + 1])
    _, first, back = np.unique(code, return_index=True, return_inverse=True)
    out = np.zeros((len(first), landmarks.table.shape[1]), np.float32)
    if len(first):
        distinct = words.pick(near[first])
        reach = distinct.sums(landmarks.group) >= FLOOR
        for g in np.flatnonzero(reach.any(axis=0)):
            these = np.flatnonzero(reach[:, g])
            columns = slice(g * _GROUP, (g + 1) * _GROUP)
            out[these, columns] = np.clip((distinct.pick(these).kernel(landmarks.table[:, columns]) - FLOOR) / RISE, 0, 1)
    return near, back, out


def worst_words(landmarks: Landmarks, weights: np.ndarray, words: Words, bounds: np.ndarray) -> np.ndarray:
    """For each text the greatest weighted likeness of its words; 0 for a word that is near no landmark."""
    near, back, found = likeness(landmarks, words)
    out = group_sums((found @ weights)[back], np.searchsorted(near, bounds), np.maximum)
    return np.maximum(out, 0)


def _candidates(words: Words, bounds: np.ndarray, y: np.ndarray, size: int, least: int) -> list[tuple[float, tuple]]:
    """Strings of ``size`` symbols inside words with how well they tell label 1 (G statistic).

    Of texts with label 1 count those with different next words, so that copies of a text count once.
    """
    i = np.flatnonzero(words.left >= size)
    code = np.zeros(len(i), np.int64)
    for j in range(size):
        code = (code << 5) | words.symbols[i + j]
    text = np.searchsorted(words.at[bounds], i, side="right") - 1
    pairs = np.unique(code << 32 | text)
    codes, back = np.unique(pairs >> 32, return_inverse=True)
    label = y[pairs & 0xFFFFFFFF]
    n1, n = y.sum(), len(y)
    names = span_hashes(words.symbols.astype(np.uint8), words.at[:-1], words.at[1:])
    word = np.searchsorted(words.at, i, side="right") - 1
    following = np.append(names[1:], 0)[word]
    mine = np.flatnonzero(y[text] > 0)
    _, once = np.unique(np.stack([code[mine].astype(np.uint64), following[mine]]), axis=1, return_index=True)
    pos = np.bincount(np.searchsorted(codes, code[mine][once]), minlength=len(codes))
    pos = np.minimum(pos, np.bincount(back, label))
    p, q = (pos + 0.5) / (n1 + 1), (np.bincount(back, 1 - label) + 0.5) / (n - n1 + 1)
    gain = n1 * (p * np.log(p / q) + (1 - p) * np.log((1 - p).clip(1e-9) / (1 - q).clip(1e-9)))
    good = np.flatnonzero((p > PURE * q) & (pos >= least))
    good = good[np.argsort(-gain[good], kind="stable")][:4000]
    return [(float(gain[k]), tuple(int(codes[k] >> (5 * (size - 1 - j))) & 31 for j in range(size))) for k in good]


@dataclass(frozen=True)
class ToxicityModel:
    landmarks: Landmarks | None
    weights: np.ndarray
    bias: float
    sigmoid: tuple[float, float]
    constant: float | None = None

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        z = worst_words(self.landmarks, self.weights, *_read(data, offsets)) + self.bias
        a, b = self.sigmoid
        return 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 3000,
    max_text_bytes: int = 1 << 12,
    landmarks: int = 96,
    ridge: float = 1e-3,
    seed: int = 5,
) -> ToxicityModel:
    """Fit on about ``per_class`` labelled texts of each class, of at most ``max_text_bytes``.

    Nothing else comes to the driver. ``labels`` holds the rows to learn from;
    several labels of one id count as their maximum.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna()
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    drawn = sample_per_class(known, "id", F.col("y"), per_class, 2 * per_class, seed).select("id", "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(
        F.octet_length("text") <= max_text_bytes)
    got = texts.join(F.broadcast(drawn), "id").select("id", "label", "text").collect()
    return fit_texts(sorted((r["id"], r["label"], r["text"]) for r in got), landmarks, ridge)


def fit_texts(got: list[tuple], landmarks: int = 96, ridge: float = 1e-3) -> ToxicityModel:
    """Fit on (id, label, text) triples in memory."""
    y = np.array([r[1] for r in got], np.float64)
    one = np.zeros(1, np.float32)
    if len(set(y)) < 2:
        return ToxicityModel(None, one, 0.0, (1.0, 0.0), float(y.mean()) if len(y) else 0.5)
    raw = [r[2].encode() for r in got]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    words, bounds = _read(data, offsets)
    ranked = [c for size in (4, 5, 6) for c in _candidates(words, bounds, y, size, 3)]
    # a longer string that tells nearly as well comes first: fewer ordinary words are near it
    ranked.sort(key=lambda c: (-c[0] * (1 + LONGER * len(c[1])), c[1]))
    chosen: list[np.ndarray] = []
    columns = np.zeros((_SIZE, 0), np.float32)
    for gain, string in ranked:
        if len(chosen) == landmarks or gain < TELLING * ranked[0][0]:
            break
        new = _table([np.array(string, np.int32)])
        norm = np.linalg.norm(new)
        if norm and (not chosen or (columns.T @ new / norm).max() < APART):
            chosen.append(np.array(string, np.int32))
            columns = np.hstack([columns, new / norm])
    if not chosen:
        return ToxicityModel(None, one, 0.0, (1.0, 0.0), float(y.mean()))
    order = sorted(range(len(chosen)), key=lambda j: chosen[j].tolist())  # like ones share a bound
    chosen, columns = [chosen[j] for j in order], columns[:, order]
    marks = Landmarks.of(chosen)
    values, vectors = np.linalg.eigh(columns.T.astype(np.float64) @ columns)
    nystroem = vectors @ np.diag(np.maximum(values, 1e-3) ** -0.5) @ vectors.T
    owner = np.repeat(np.arange(len(y)), np.diff(bounds))
    near, back, found = likeness(marks, words)
    texts = owner[near]
    in_clean = np.bincount(back[y[texts] == 0], minlength=len(found)) > 0

    def machine(of: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and bias learned from some texts; equal words count as often as they stand."""
        clean = np.bincount(back[of[texts] & (y[texts] == 0)], minlength=len(found))
        toxic = np.bincount(back[of[texts] & (y[texts] > 0)], minlength=len(found))
        good, bad = clean > 0, (found >= 1).any(axis=1) & (toxic > 0) & ~in_clean
        w, b = _squared_hinge(  # words near no landmark are all alike: one row, once for each clean text
            np.vstack([np.zeros((1, len(chosen))), found[good], found[bad]]) @ nystroem,
            np.concatenate([-np.ones(1 + good.sum()), np.ones(bad.sum())]),
            np.concatenate([[(of & (y == 0)).sum()], clean[good], toxic[bad]]), ridge,
        )
        return nystroem @ w, b

    z, some = np.zeros(len(y)), np.zeros(len(y), bool)
    for fold in range(FOLDS):
        held = np.arange(len(y)) % FOLDS == fold
        w, b = machine(~held)
        z[held] = (worst_words(marks, w, words, bounds) + b)[held]
        some |= held & (z > b)  # of texts without a likeness the sigmoid can learn nothing
    if len(set(y[some])) < 2:
        some[:] = True
    w, b = machine(np.ones(len(y), bool))
    return ToxicityModel(marks, w.astype(np.float32), b, _platt(z[some], y[some]))


def _squared_hinge(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 40
) -> tuple[np.ndarray, float]:
    """Primal squared-hinge machine by Newton steps on the rows inside the margin."""
    x = np.hstack([x, np.ones((len(x), 1))])
    total = {side: max(1.0, weight[y == side].sum()) for side in (1, -1)}
    cost = 0.5 * weight / np.where(y > 0, total[1], total[-1])
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    keep[-1, -1] = 1e-8
    for _ in range(steps):
        inside = y * (x @ w) < 1
        xs = x[inside] * cost[inside, None]
        new = np.linalg.solve(keep + xs.T @ x[inside], xs.T @ y[inside])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid, by Newton steps with Platt's softened targets."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.stack([z, np.ones_like(z)], 1), np.array([2.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        w = w - 0.7 * np.linalg.solve(h, x.T @ (p - t))
    return float(max(w[0], 1e-3)), float(w[1])
