"""SentencePiece ids and texts against the library's own calls on whole texts."""

from __future__ import annotations

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tillflow.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    None, "", " ", "   ", "a", " a", "a ", "  a  b ", "a\n\nb\r\n c\t", "▁", "a▁b ▁ c", "é é 日本語 ①", "\x00 \x01", "<s> </s> <0x41>", "🎉🎉 x",
    "word " * 5000, "x" * 20000, "same same", "same same",
]


def expected(text):
    ids = MODEL.encode(text or "")
    return ids, MODEL.decode(ids)


def test_encode_and_decode(spark):
    rows = [(i % 17, t) for i, t in enumerate(TEXTS)] + [(None, "key is null")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "text AS key", "1 AS ids", "2 AS decoded").repartition(3)
    got = pieces.encode(df, pieces.model_bytes(PATH))
    want = sorted(((i, *expected(t)) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got.collect()), key=repr) == want
    back = pieces.decode(got, pieces.model_bytes(PATH))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t) for i, _, t in want), key=repr)


def test_empty_table(spark):
    assert pieces.encode(spark.createDataFrame([], "doc_id bigint, text string"), pieces.model_bytes(PATH)).count() == 0


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pieces.encode(docs, pieces.model_bytes(PATH)).collect():
        assert (list(r["ids"]), r["decoded"]) == expected(texts[r["doc_id"]])


@settings(deadline=None, max_examples=300)
@given(st.lists(st.text(alphabet=st.sampled_from(" ▁\n\tabcé日①\x00.")) | st.text(), max_size=5))
def test_any_text(texts):
    ids, decoded = pieces.WordTable(MODEL, limit=4).look_up(texts)
    for text, i, d in zip(texts, ids, decoded, strict=True):
        assert (list(memoryview(i).cast("i")) if i else [], d) == expected(text)


def test_pieces_that_cross_words_are_noticed():
    class Other:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    assert not pieces.separable(Other())


@pytest.mark.parametrize("text", ["a b", " a"])
def test_whole_text_where_words_depend_on_each_other(text, monkeypatch):
    monkeypatch.setattr(pieces, "separable", lambda model: False)
    ids, decoded = pieces.WordTable(MODEL).look_up([text])
    assert (list(memoryview(ids[0]).cast("i")), decoded[0]) == expected(text)
