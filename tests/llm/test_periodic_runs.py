"""Runs against the definition, every period of every document tried."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF, prose
from tiermill.llm import periodic_runs, queries


def brute(words, least=12):
    """All runs by definition: a stretch at each lag, kept if no smaller lag holds on it."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(least, 2 * q) and not any(
                all(words[t] == words[t + p] for t in range(s, e - p)) for p in range(1, q)
            ):
                out.append((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(docs, least=12):
    number = {}
    lists = [[number.setdefault(w, len(number)) for w in d] for d in docs]
    bounds = np.cumsum([0, *map(len, lists)])
    words = np.array([w for d in lists for w in d], np.int64)
    out = [[] for _ in docs]
    for row, *run in zip(*(c.tolist() for c in periodic_runs.runs_of(words, bounds, least)), strict=True):
        out[row].append(tuple(run))
    return out


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def thue_morse(n):
    return [str(bin(i).count("1") % 2) for i in range(n)]


def planted(seed, period, times, before, after, letters=1000):
    rng = random.Random(seed)
    word = [rng.randrange(letters) for _ in range(period)]
    body = (word * (int(times) + 1))[: int(period * times)]
    return [rng.randrange(letters) for _ in range(before)] + body + [rng.randrange(letters) for _ in range(after)]


SHAPES = {
    "one word": list("a" * 300),
    "fibonacci": fibonacci(377),
    "thue-morse": thue_morse(512),
    "two ways around a seam": list("ab" * 60 + "a" + "ab" * 60),
    "stretches of one word": list(("a" * 50 + "b") * 9),
    "stretches of several lengths": list("a" * 70 + "b" + "a" * 45 + "b" + "a" * 90 + "bb" + "a" * 70 + "b"),
    "period of periods": list((("abc" * 7 + "x") * 4 + "yz") * 3),
    "squares of long words": planted(1, 97, 2, 13, 8) + planted(2, 41, 2.5, 3, 0) + planted(3, 128, 2, 0, 1),
    "just too short": planted(4, 60, 1.98, 20, 20),
    "nearly periodic": [w if i % 83 else "!" for i, w in enumerate(list("abcdefghijklmnopqrs") * 30)],
    "blocks": list("ab" * 33 + "abc" * 20) * 3,
}


@pytest.mark.parametrize("name", SHAPES)
def test_shapes(name):
    assert found([SHAPES[name]]) == [brute(SHAPES[name])]


def test_shapes_side_by_side_do_not_mix():
    docs = [*SHAPES.values(), [], ["x"], *SHAPES.values()]
    assert found(docs) == [brute(d) for d in docs]


@pytest.mark.parametrize("seed", range(40))
def test_random(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(6):
        parts = []
        for _ in range(rng.randint(1, 6)):
            word = rng.choices("ab" if rng.random() < 0.6 else "abcdef", k=rng.randint(1, 60))
            parts += (word * rng.randint(1, 8))[: rng.randint(1, 160)]
        docs.append(parts[:420])
    assert found(docs) == [brute(d) for d in docs]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9).flatmap(
    lambda w: st.integers(1, 30).map(lambda k: w * k)), max_size=6), st.integers(2, 14))
def test_any(blocks, least):
    words = [w for b in blocks for w in b][:400]
    assert found([words], least) == [brute(words, least)]


def test_a_long_text_of_one_line_and_of_long_stretches_ends_soon():
    line = prose(1, 9).split()
    n = len(line) * 30_000
    assert found([line * 30_000]) == [[(0, n, len(line))]]
    words = (["na"] * 20_000 + ["x"]) * 6
    runs = found([words])[0]
    assert (0, 6 * 20_001, 20_001) in runs
    assert sum(q == 1 for _, _, q in runs) == 6


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(text):
    return (text or "").encode().split()


def test_messy_rows(messy, empty):
    rows = periodic_runs.detect(messy).collect()
    assert len(rows) == messy.count()
    for r, t in zip(rows, messy.select("doc_id", "text").collect(), strict=True):
        words = [w.decode() for w in words_of(t["text"])]
        assert r["n_words"] == len(words)
        if len(words) < 2_000:
            runs = brute(words)
            assert [tuple(x) for x in r["runs"]] == runs
            assert r["collapsed"] == collapsed(words, runs)
    assert periodic_runs.detect(empty).count() == 0


def test_query(spark, documents):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    tried = 0
    for r in rows:
        words, h = [w.decode() for w in words_of(r["text"])], zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 700:
            continue
        tried += 1
        runs, g = brute(words), got[r["doc_id"]]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (g["n_runs"], g["start"], g["length"], g["period"]) == (len(runs), *best)
        assert g["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert g["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert g["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert tried > 100
