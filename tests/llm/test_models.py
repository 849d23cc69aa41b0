"""Classifiers: held-out accuracy, and defined results on messy rows."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tiermill.llm import langid, quality, toxicity
from tiermill.llm.queries import op4_toxicity, op8_quality, op10_language_id

INSULTS = ["blockhead", "numskull", "dimwit"]


def spoiled(word: str, rng: random.Random) -> str:
    """An insult with a character put in, or its letters written otherwise."""
    k = rng.randint(1, len(word) - 1)
    return rng.choice([word, word.upper(), word[:k] + "*" + word[k:], word.replace("o", "0").replace("i", "1"), word + "ish,"])


def talk(n: int = 240) -> list[tuple]:
    rng = random.Random(0)
    rows = []
    for i in range(n):
        words = prose(7000 + i, rng.randint(8, 60)).split()
        toxic = i % 3 == 0
        if toxic:
            words.insert(rng.randint(0, len(words)), spoiled(rng.choice(INSULTS), rng))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_tells_spoiled_insults():
    rows = talk()
    model = toxicity.fit_texts([(i, y, t) for i, t, y in rows if i % 2])
    held = [(t.encode(), y) for i, t, y in rows if i % 2 == 0]
    data = np.frombuffer(b"".join(t for t, _ in held), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in held])])
    scores = model.scores(data, offsets)
    y = np.array([y for _, y in held])
    assert ((scores >= 0.5) == y).mean() > 0.95


def plain_kernel(word: list[int], other: list[int]) -> float:
    """Sum over shared three-character subsequences of the decays of their least spans in either."""
    def spans(s):
        out = {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < 5:
                out[s[i], s[j], s[k]] = min(out.get((s[i], s[j], s[k]), 9), k - i + 1)
        return out

    a, b = spans(word), spans(other)
    return sum(toxicity.DECAY ** (a[f] + b[f]) for f in a.keys() & b.keys())


def plain_words(text: str) -> list[list[int]]:
    """Words without signs, runs of single letters joined."""
    out, single = [], False
    for word in text.lower().split():
        letters = [ord({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}.get(c, c)) - 96 for c in word if c in "abcdefghijklmnopqrstuvwxyz013457"]
        if not letters:
            continue
        if len(letters) == 1 and single:
            out[-1] += letters
        else:
            out.append(letters)
        single = len(letters) == 1
    return out


def test_worst_words_against_a_plain_kernel():
    strings = [[2, 12, 15, 3, 11], [4, 9, 13, 23, 9, 20], [8, 5, 1, 4], [15, 12, 15, 12]]
    marks = toxicity.Landmarks.of([np.array(s) for s in strings])
    weights = np.array([1.0, 0.5, -0.75, 2.0], np.float32)
    texts = [t for _, t, _ in talk(60)] + ["b-l-o-c-k", "d i m . w i t x", "h e", "", "?! -", "lolololol o l", "bl0ckhe4d's", "a b dimxwit"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    found = toxicity.worst_words(marks, weights, *toxicity._read(data, offsets))
    for text, got in zip(texts, found, strict=True):
        z = [0.0]
        for word in plain_words(text):
            like = np.array([plain_kernel(word, s) / plain_kernel(s, s) for s in strings])
            z.append(float(np.clip((like - toxicity.FLOOR) / toxicity.RISE, 0, 1) @ weights))
        assert abs(got - max(z)) < 1e-4, text
    assert found.max() > 0.9


def test_one_insult_parted_by_signs_spaces_or_a_letter_is_found():
    rows = talk(600)
    model = toxicity.fit_texts([(i, y, t) for i, t, y in rows])
    clean = [t.split() for _, t, y in rows if not y]

    def score(text: str) -> float:
        raw = text.encode()
        return float(model.scores(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])

    for n, word in enumerate(INSULTS):
        for form in (word, "-".join(word), " ".join(word), word.upper() + "!!", word[:4] + "x" + word[4:]):
            words = clean[n][:20]
            assert score(" ".join([*words[:10], form, *words[10:]])) >= 0.7, form
    assert np.mean([score(" ".join(w)) >= 0.7 for w in clean]) < 0.02


def check_scores(rows, ids):
    assert sorted(r[0] if r[0] is not None else -1 for r in rows) == sorted(i if i is not None else -1 for i in ids)
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_of_messy_rows_and_empty_tables(spark, messy, empty, module):
    label = "toxic" if module is toxicity else "quality"
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 17)] + [(3, 1), (99, 0), (4, None)], f"doc_id long, {label} int")
    model = module.fit(messy, labels)
    ids = [r["doc_id"] for r in messy.select("doc_id").collect()]
    check_scores(quality.score(messy, model).collect(), ids)
    assert quality.score(empty, model).collect() == []
    unlearned = module.fit(empty, labels.limit(0))
    assert {r["score"] for r in quality.score(messy, unlearned).collect()} == {0.5}
    same = {r["score"] for r in quality.score(messy.where("doc_id in (1, 2)"), model).collect()}
    assert len(same) == 1


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = op8_quality(spark, sf).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.93


def test_toxicity_query_covers_all_rows(spark, documents):
    rows = op4_toxicity(spark, "/root/testdata/sf0.001").collect()
    check_scores(rows, [r["doc_id"] for r in documents.select("doc_id").collect()])
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = op10_language_id(spark, sf).join(docs, "doc_id").where("held_out and lang is not null")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


def test_languages_of_messy_rows(spark, messy, empty, documents):
    model = langid.fit(documents)
    found = {r["doc_id"]: r for r in langid.identify(messy, model).collect()}
    assert len(found) == messy.select("doc_id").distinct().count()
    for i in (4, 5, 6, 13):
        assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"]
    assert found[1]["lang_pred"] == "en"
    kept = langid.accepted(messy, model)
    assert kept.columns == messy.columns
    assert {4, 5, 6, 13}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert kept.where("doc_id in (1, 2, 9)").count() == 3
    assert langid.identify(empty, model).collect() == [] and langid.accepted(empty, model).collect() == []
    nothing = langid.fit(empty)
    assert {r["lang_pred"] for r in langid.identify(messy, nothing).collect()} == {"und"}
