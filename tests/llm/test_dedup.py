import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import prose
from tiermill.llm import ngram_join, suffix_dedup
from tiermill.llm.common import smallest_reachable, with_key

# -- suffix arrays -----------------------------------------------------------


def covered(texts: list[bytes], length: int, keep: str) -> list[np.ndarray]:
    """Brute force: which bytes go, texts in order of their place in the corpus."""
    seen = Counter()
    for t in texts:
        seen.update(t[i : i + length] for i in range(len(t) - length + 1))
    out, before = [], set()
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if (seen[s] > 1) if keep == "none" else (s in before):
                gone[i : i + length] = True
            before.add(s)
        out.append(gone)
    return out


def digest_of(text: bytes, gone: np.ndarray) -> tuple:
    spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
    return len(text), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(text, np.uint8)[~gone])).hexdigest()


@pytest.mark.parametrize("length", [40, 400])
def test_digest_of_messy_rows(messy, length):
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in messy.select("doc_id", "text").collect()]
    want = sorted((-1 if i is None else i, *digest_of(t, g)) for (i, t), g in zip(texts, covered([t for _, t in texts], length, "none"), strict=True))
    rows = suffix_dedup.digest(messy, length=length).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == want


def test_digest_of_documents(documents):
    texts = [(r["doc_id"], r["text"].encode()) for r in documents.orderBy("doc_id").collect()]
    want = {i: digest_of(t, g) for (i, t), g in zip(texts, covered([t for _, t in texts], 400, "none"), strict=True)}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.digest(documents).collect()}
    assert got == want
    assert sum(w[1] for w in want.values()) > 0


def words_covered(texts: list[str], length: int, keep: str) -> list[set]:
    """Brute force over words: which word numbers go, or (shared) stand in another text as well."""
    lists = [t.split() for t in texts]
    where = defaultdict(list)
    for d, w in enumerate(lists):
        for i in range(len(w) - length + 1):
            where[tuple(w[i : i + length])].append((d, i))
    out = [set() for _ in texts]
    for places in where.values():
        for d, i in places:
            gone = {"none": len(places) > 1, "first": (d, i) != min(places), "shared": len({x for x, _ in places}) > 1}[keep]
            if gone:
                out[d].update(range(i, i + length))
    return out


def awkward_texts() -> list[str]:
    shared = prose(50, 90)
    texts = [prose(100 + i, 40) + " " + shared + " " + prose(200 + i, 30) for i in range(12)]
    texts += [" ".join(shared.split()[i:]) + " " + prose(400 + i, 9) for i in range(0, 40, 3)]
    # periodic texts name many anchors of one gram, near their starts as well
    return texts + ["ab " * 90 + prose(7, 9), "ab " * 80 + prose(8, 9), "x" + "ab " * 60, "b ab " + "ab " * 55 + "q", prose(9, 3) + " ab" * 70]


@pytest.mark.parametrize("keep", ["none", "first", "shared"])
@pytest.mark.parametrize("part_rows", [100_000, 1, 3])
def test_parts_of_any_size_give_the_same_ranges(spark, keep, part_rows):
    texts = awkward_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keyed = with_key(docs, "doc_id", "text")

    def units(length, unit):
        out, size = defaultdict(set), {i: len(t.encode() if unit == "bytes" else t.split()) for i, t in enumerate(texts)}
        for r in suffix_dedup.repeats(keyed, length, unit, keep, part_rows=part_rows).collect():
            assert 0 <= r["lo"] < r["hi"] <= size[r["key"]]
            out[r["key"]].update(range(r["lo"], r["hi"]))
        return out

    want, got = words_covered(texts, 20, keep), units(20, "words")
    if keep == "shared":
        assert {i for i, w in enumerate(want) if w} == set(got)
        assert all(got[i] <= want[i] for i in got)
        return
    assert [got[i] for i in range(len(texts))] == want
    want, got = covered([t.encode() for t in texts], 120, keep), units(120, "bytes")
    assert all(got[i] == set(np.flatnonzero(want[i]).tolist()) for i in range(len(texts)))


def test_words_are_cut_out_whole(spark):
    texts = awkward_texts() + ["  " + prose(50, 90).replace(" ", "\n\t ") + "  tail é"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in suffix_dedup.remove_repeats(docs, 20, "words").collect()}
    for i, gone in enumerate(words_covered(texts, 20, "first")):
        assert out[i].split() == [w for k, w in enumerate(texts[i].split()) if k not in gone]
    assert out[len(texts) - 1].startswith("  ") and out[len(texts) - 1].endswith("  tail é")


def test_shares_passage(spark):
    texts = [prose(1, 200), prose(2, 200), prose(3, 60) + " " + prose(1, 51), prose(4, 60) + " " + prose(2, 50), "a b c " * 60, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["shares_passage"] for r in suffix_dedup.digest(docs).collect()}
    assert got == {0: 1, 1: 0, 2: 1, 3: 0, 4: 0, 5: 0}


def test_nearest_smaller_positions_and_matches():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 200):
        values = rng.permutation(n)
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(n)]
        assert suffix_dedup.previous_smaller(values).tolist() == want
        rank = rng.integers(0, max(1, n // 3), n)
        for later in (False, True):
            sign = -1 if later else 1
            got = suffix_dedup.has_match(rank, values, later)
            assert got.tolist() == [any(rank[j] == rank[i] and sign * values[j] < sign * values[i] for j in range(n)) for i in range(n)]


def test_remove_repeats_keeps_the_first_and_other_columns(messy, empty):
    out = suffix_dedup.remove_repeats(messy, length=60, keep="first")
    assert out.columns == messy.columns and out.count() == messy.count()
    texts = {r["doc_id"]: r["text"] for r in out.where("doc_id <> 15").collect()}
    before = {r["doc_id"]: r["text"] for r in messy.where("doc_id <> 15").collect()}
    assert texts[1] == before[1] and texts[2] == "" and texts[4] is None and texts[5] == ""
    assert texts[9] == before[9] and len(texts[10]) < len(before[10])
    assert sorted(len(r["text"]) > 0 for r in out.where("doc_id = 15").collect()) == [False, True]
    assert suffix_dedup.remove_repeats(empty, length=60).collect() == []
    assert suffix_dedup.digest(empty).collect() == []


def test_window_ranks_sort_as_strings():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 300)
    for length in (3, 8, 13, 50):
        rank = suffix_dedup.window_ranks(data, length)
        strings = [tuple(data[i : i + length].tolist()) for i in range(len(data))]
        order = {s: k for k, s in enumerate(sorted(set(strings)))}
        assert [order[s] for s in strings] == rank.tolist()


def test_a_very_long_text_is_read_in_parts(spark, monkeypatch):
    text = prose(9, 900) + prose(10, 200) + prose(9, 300)
    for unit, length in (("bytes", 100), ("words", 17)):
        data = np.frombuffer(text.encode(), np.uint8)
        symbols, offsets = suffix_dedup._symbols(data, np.array([0, len(data)]), unit)
        whole = set(zip(*(c.tolist() for c in suffix_dedup._anchors_of(symbols, offsets, length, 5)[1:]), strict=True))
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 300)
        assert (suffix_dedup._symbols(data, np.array([0, len(data)]), unit)[0] == symbols).all()
        if unit == "words":
            starts, ends = suffix_dedup._word_places(data)
            assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == text.split()
        monkeypatch.setattr(suffix_dedup, "_PLACE", 9)
        pieces = list(suffix_dedup._pieces(symbols, offsets, length))
        monkeypatch.setattr(suffix_dedup, "_PLACE", 22)
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1 << 20)
        parts = set()
        for part, off, base, lo, hi in pieces:
            _, at, first, last, kh, ch = suffix_dedup._anchors_of(part, off, length, 5)
            rows = zip(*(c.tolist() for c in (at + base, first + base, last + base, kh, ch)), strict=True)
            parts |= {r for r in rows if lo <= r[0] < hi}
        assert len(pieces) > 3 and parts == whole


# -- n-gram Jaccard ----------------------------------------------------------


def sets_of(texts, k):
    out = {}
    for i, t in texts.items():
        words, word = [], b""
        for b in (t or "").encode() + b" ":
            if b == 32 or 9 <= b <= 13:
                if word:
                    words.append(word)
                word = b""
            else:
                word += bytes([b + 32 if 65 <= b <= 90 else b])
        out[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    return out


def slow_components(texts: dict, k: int, percent: int) -> dict:
    sets = sets_of(texts, k)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    names = sorted(sets)
    for x in names:
        for y in names:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(spark, n=60):
    """Copies of a few texts with more and more words changed, so that components chain."""
    rows = []
    for i in range(n):
        words = prose(300 + i % 3, 120).split()
        for j in range(i // 3):
            words[(7 * j * (i % 5 + 1)) % len(words)] = f"w{j}"
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (1, 70)])
def test_components_against_brute_force(spark, words, percent):
    docs = near_copies(spark)
    want = slow_components({r["doc_id"]: r["text"] for r in docs.collect()}, words, percent)
    found = ngram_join.components(with_key(docs, "doc_id", "text"), words, percent).collect()
    assert {r["id"]: (r["n"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values()}) < len(want) - 3


def test_components_of_messy_rows(messy, empty):
    rows = with_key(messy, "doc_id", "text")
    found = ngram_join.components(rows, 4, 85).collect()
    texts = {r["key"]: r["text"] for r in rows.collect()}
    want = slow_components(texts, 4, 85)
    assert {r["key"]: (r["n"], r["component"]) for r in found} == want
    assert ngram_join.components(with_key(empty, "doc_id", "text"), 4, 85).collect() == []


def test_one_per_component(messy):
    out = ngram_join.one_per_component(messy, words=5, percent=80)
    assert out.columns == messy.columns
    ids = sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=lambda i: -1 if i is None else i)
    # 2 and 3 are near 1, one of the 15s stays, 17 has the words of 8
    assert ids == [None, 1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 18]


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64)) for _ in range(2))
        both = rng.integers(0, 2**63, rng.integers(0, 300)).astype(np.uint64)
        a, b = np.union1d(a, both), np.union1d(b, both)
        assert ngram_join.least_difference(ngram_join._sketch(a), ngram_join._sketch(b)) <= len(np.setxor1d(a, b))


def test_smallest_reachable(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: find(i) for i in list(root) if find(i) != i}
    assert got == want
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).collect() == []
