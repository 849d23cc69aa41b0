import hashlib

import numpy as np

from tiermill.llm import spotsigs


def slow_signatures(text: str) -> set:
    words, word = [], b""
    for b in (text or "").encode() + b" ":
        c = bytes([b + 32 if 65 <= b <= 90 else b])
        if b >= 128 or c.isalnum():
            word += c
        elif word:
            words.append(word.decode(errors="replace"))
            word = b""
    content = [(i, w) for i, w in enumerate(words) if w not in spotsigs.ANCHORS]
    out = set()
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            chain = [c for j, c in content if j > i][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                out.add((w, *chain))
    return out or ({tuple(words)} if words else set())


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, docs):
    """Rows against brute force; docs: (id, text) in order."""
    rows = list(rows)
    assert len(rows) == len(docs)
    got = sorted(
        (r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9), r["n_signatures"]) for r in rows
    )
    want = []
    for i, (_, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        edited = spotsigs.edit(text, following)
        own = slow_signatures(text)
        want.append((len(text), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(own, slow_signatures(edited)), 9),
                     round(jaccard(own, slow_signatures(following)), 9), len(own)))
    assert got == sorted(want)


def test_messy_rows_against_brute_force(messy):
    docs = sorted(((r["doc_id"], r["text"] or "") for r in messy.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    check(spotsigs.fingerprint_with_next(messy).collect(), docs)


def test_real_rows_against_brute_force(documents):
    docs = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    rows = spotsigs.fingerprint_with_next(documents).collect()
    check(rows, docs)
    text = dict(docs)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_one_row_follows_itself_and_empty_table(messy, empty):
    row = spotsigs.fingerprint_with_next(messy.where("doc_id = 9")).collect()
    assert len(row) == 1 and row[0]["near_next"] == 1.0
    assert spotsigs.fingerprint_with_next(empty).collect() == []


def test_pruned_jaccard_is_exact_or_zero():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 40, rng.integers(0, 30))) for _ in range(2))
        exact = jaccard(set(a.tolist()), set(b.tolist()))
        assert spotsigs.pruned_jaccard(a, b) == exact
        assert spotsigs.pruned_jaccard(a, b, 0.5) == (exact if exact >= 0.5 else 0.0)


def test_fingerprint_reads_back_and_length_classes_neighbour(spark):
    sig = spotsigs.signatures([b"the quick brown fox jumps over a lazy dog here"])[0]
    assert (spotsigs.read_fingerprint(spotsigs.fingerprint_text(sig)) == sig).all() and len(sig) == 2
    from pyspark.sql import functions as F

    k = {r["id"]: r["k"] for r in spark.range(1, 400).select("id", spotsigs.length_class(F.col("id")).alias("k")).collect()}
    assert all(abs(k[a] - k[b]) <= 1 for a in k for b in k if min(a, b) >= 0.8 * max(a, b))
