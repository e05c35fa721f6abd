from __future__ import annotations

import re
from itertools import permutations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tillflow.llm import filter_audit, transducer

LETTERS = st.text(st.sampled_from("aAbZé漢😀 \t\n\x0b\x0c\r\x1c\x85 #$%&*|x"), max_size=60)


def facts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))


def found(texts):
    c = transducer.counted([t.encode() for t in texts])
    return list(zip(c.words.tolist(), c.distinct.tolist(), c.capitals.tolist(), c.points.tolist(), c.symbols.tolist(), strict=True))


@given(st.lists(LETTERS, max_size=12))
def test_counts(texts):
    assert found(texts) == [facts(t) for t in texts]


@given(st.lists(LETTERS, max_size=6), st.integers(1, 9))
def test_state_goes_on_from_block_to_block(texts, block):
    whole, transducer.BLOCK = transducer.BLOCK, block
    try:
        assert found(texts) == [facts(t) for t in texts]
    finally:
        transducer.BLOCK = whole


def test_very_long_text_and_words():
    texts = ["ab cd " * 400_000, "x" * 3_000_000 + " " + "x" * 2_999_999 + " " + "x" * 3_000_000, "", " \n" * 100_000, " ".join(f"w{i % 50_000}é" for i in range(200_000))]
    assert found(texts) == [facts(t) for t in texts]


def test_spans_are_compared_in_owner_length_and_bytes():
    values = [np.arange(300, dtype=np.uint64) % 70]
    size, owner = np.full(300, 3), np.arange(300) // 150
    assert transducer.inserted([values[0] * np.uint64(0)], size, owner, 2).tolist() == [1, 1]
    assert transducer.inserted(values, size, owner, 2).tolist() == [70, 70]


def fails(rows, i):
    doc, _, text = rows[i]
    words, distinct, capitals, points, symbols = facts(text or "")
    copies = [d for d, _, t in rows if (t or "") == (text or "") and d is not None and (doc is None or d < doc)]
    return {f for f, yes in zip("ABCDE", [words < 200, 100 * distinct < 50 * words, 100 * capitals > 3 * points, symbols > 0, copies], strict=True) if yes}


def plain(rows, labels):
    out = {}
    docs = [(part or "", doc, fails(rows, i)) for i, (doc, part, _) in enumerate(rows)]
    marks = lambda doc, at: doc is not None and any(r[0] == doc and r[at] == 1 for r in labels)
    for part in {p for p, _, _ in docs}:
        own = [(doc, f) for p, doc, f in docs if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [(d, x) for d, x in left if f in x]
                left = [(d, x) for d, x in left if f not in x]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f in x for _, x in own) - len(removed), sum(x == {f} for _, x in own),
                    sum(marks(d, 1) for d, _ in removed), sum(marks(d, 2) for d, _ in removed),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return sorted((p, o, s, *row) for (p, o, s), row in out.items())


ROWS = [
    (1, "en", "a b c"), (2, "en", "a b c"), (2, "en", "a b c"), (None, "de", "a b c"), (3, None, None), (4, "", ""), (5, "de", " \t"), (6, "de", "# A"),
    (7, "en", " ".join(f"w{i}" for i in range(200))), (8, "en", "same " * 300), (9, "fr", " ".join(f"W{i}" for i in range(250))), (None, "xx", None),
    (None, "fr", "only null"), (None, "fr", "only null"), (10, "fr", "é " * 5), (9_223_372_036_854_775_807, "fr", "é " * 5), (-5, "fr", "é " * 5), (11, "en", "x" * 200_000),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, None), (None, 1, 1), (8, 1, 1), (99, 1, 1)]


def test_against_plain_orders(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, lang string, text string").selectExpr("*", "1 AS key", "'p' AS part", "2 AS n", "'s' AS sha", "3 AS mask").repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").selectExpr("*", "'x' AS key", "2 AS n", "'l' AS lang")
    got = filter_audit.audit(filter_audit.cells(docs, labels))
    assert sorted(map(tuple, got.collect())) == plain(ROWS, LABELS)


def test_one_text_and_one_id_in_a_third_of_all_rows(spark):
    rows = [(7 if i % 3 == 0 else i, "en", "hot text" if i % 3 else f"own {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(9)
    got = filter_audit.audit(filter_audit.cells(docs, spark.createDataFrame([(7, 1, 1)], "doc_id bigint, quality int, toxic int")))
    assert sorted(map(tuple, got.collect())) == plain(rows, [(7, 1, 1)])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(filter_audit.cells(docs, labels)).collect() == []
