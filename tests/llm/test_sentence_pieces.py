"""Encoding against the library itself, text by text."""

import functools
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import SF, prose
from tiermill.llm import queries, sentence_pieces
from tiermill.llm.sentence_pieces import Codec, parts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", " \n", "\n ", "a", " a", "a ", "  a  b  ", "a\nb", "a \n b", "\n\n\na  \n", "▁", "a▁▁b", "▁ ▁x",
       "\t\tx\ty", "12 345", "é è 😀 ‍中文字 x", "a\u0000b", "� x", "\r\n\r\n", " " * 40 + "x" + " " * 17, "</s> <s> <unk> <0x0A>", "x" * 3000]


@functools.cache
def shared() -> Codec:
    return Codec(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    found = Codec(PATH)
    assert found.by_chunks and found.by_lines
    return found


def ids_of(codec, text):
    import numpy as np

    return np.frombuffer(codec.encode([text])[0], "<i4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, codec, text):
    want = library.encode(text)
    assert ids_of(codec, text) == want
    assert codec.decode([*want, codec.end]) == library.decode([*want, codec.end])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t▁aAbZ019.,é中😀́-")), max_size=60))
def test_any_text(text):
    codec = shared()
    library = codec.model
    want = library.encode(text)
    assert ids_of(codec, text) == want
    assert codec.decode(want) == library.decode(want)


@pytest.mark.parametrize("ids", [[0, 5, 6], [1, 2], [300, 2, 400], [10, 259, 3 + 0xE4], [3 + 0xFF, 3 + 0x41], [2]])
def test_unusual_ids_decode_as_the_library_does(library, codec, ids):
    assert codec.decode(ids) == library.decode(ids)


def test_parts_of_a_long_text(codec, monkeypatch):
    text = (prose(3, 2_000) + "  \n  ") * 3
    cuts = list(parts(text, 500))
    assert len(cuts) > 10 and cuts[0][0] == 0 and cuts[-1][1] == len(text)
    joined = [c for a, b in cuts for c in codec.chunks_between(text, a, b)]
    assert joined == codec.chunks(text)
    monkeypatch.setattr(sentence_pieces, "SLICE_CHARS", 300)
    monkeypatch.setattr(sentence_pieces.parts, "__defaults__", (300,))
    assert ids_of(codec, text) == codec.model.encode(text)


def test_table_is_bounded_and_a_model_without_the_rule_is_asked_whole():
    small = Codec(PATH, table_chars=200)
    for i in range(20):
        text = prose(i, 50)
        assert ids_of(small, text) == small.model.encode(text)
        assert len(small.table) < 120
    small.by_chunks = small.by_lines = False
    assert ids_of(small, "a  b\nc") == small.model.encode("a  b\nc")


def test_messy_rows(spark, messy, empty, library):
    enc = sentence_pieces.encode(messy, PATH)
    assert enc.columns == ["doc_id", "ids"]
    rows = sentence_pieces.decode(enc, PATH).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in messy.select("doc_id", "text").collect()}
    assert len(rows) == messy.count()
    for r in rows:
        assert r["ids"] == [*library.encode(texts[r["doc_id"]]), 2]
        assert r["decoded"] == library.decode(r["ids"])
    assert sentence_pieces.decode(sentence_pieces.encode(empty, PATH), PATH).count() == 0
    with pytest.raises(ValueError):
        sentence_pieces.decode(enc, PATH, out_col="ids")
    holes = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in sentence_pieces.decode(holes, PATH).orderBy("doc_id").collect()] == [None, ""]


def test_query(spark, documents, library):
    got = {r["doc_id"]: r for r in queries.op11_sentencepiece(spark, SF).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"] or "") + [2]
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
