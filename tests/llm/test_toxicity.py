from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.compare import duck
from tillflow.llm import queries, toxicity

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def made(n=1200, share=0.15, seed=5):
    """Texts of which a share holds words from a list that no other text uses; half of them are labelled."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < share
        text = words(rng, rng.randint(1, 60))
        if toxic:
            text += " ".join(["", *rng.sample(["Scoundrel!", "knave,", "villain", "wretch", "zlomyslný"], 3)]) + " " + words(rng, 3)
        docs.append((i, text))
        if rng.random() < 0.5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def result(spark, docs, labels, parts=4):
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS key", "'p' AS print", "0.5D AS score", "3 AS toxic").repartition(parts)
    l = spark.createDataFrame(labels, LABELS).selectExpr("*", "'k' AS key", "'t' AS text", "1 AS mark")
    return sorted(map(tuple, toxicity.scored(d, toxicity.fit(d, l)).collect()), key=repr)


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_finds_unseen_toxic_texts_and_leaves_others(spark):
    docs, labels = made()
    found = {i: (h, s, p) for i, h, s, p in result(spark, docs, labels)}
    assert all(found[i][0] == held(i) for i, _ in docs)
    unseen = [(found[i][2], "oundrel" in t or "knave" in t or "villain" in t or "wretch" in t) for i, t in docs if held(i)]
    assert sum(p and y for p, y in unseen) >= 0.9 * sum(y for _, y in unseen) and sum(p and not y for p, y in unseen) <= 2
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p in found.values())


def test_held_out_labels_and_order_of_rows_change_nothing(spark):
    docs, labels = made(500)
    first = result(spark, docs, labels)
    turned = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    rng = random.Random(1)
    rng.shuffle(turned)
    assert result(spark, rng.sample(docs, len(docs)), turned, parts=7) == first


def test_repeats_and_a_text_in_a_third_of_all_rows(spark):
    docs, labels = made(600)
    docs += [(10_000 + i, "the same old text") for i in range(300)] + docs[:3] + [(None, docs[5][1]), (None, None), (20_000, None), (20_001, ""), (20_002, " \n")]
    docs += [(30_000, "knave villain wretch scoundrel " * 100_000), (30_001, "x" * 2_000_000)]
    labels += [labels[0], (None, 1, 1), (labels[1][0], 0, None), (777_777, 0, 1)]
    found = result(spark, docs, labels)
    assert len(found) == len(docs)
    by = {}
    for i, _, s, _ in found:
        by.setdefault(i, set()).add(s)
    assert all(len(by[i]) == 1 for i, _ in docs[:3])
    assert by[20_000] == by[20_001] == by[20_002] and by[20_000] <= by[None]
    assert all(p == 0 for i, _, _, p in found if i in (20_000, 10_005, 30_001)) and next(p for i, _, _, p in found if i == 30_000) == 1


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1)], [(1, None, None)]])
def test_without_examples_all_scores_are_zero(spark, labels):
    docs = [(1, "some words"), (2, "other words"), (None, None)]
    assert {(s, p) for _, _, s, p in result(spark, docs, labels)} == {(0.0, 0)}


def test_empty_tables(spark):
    assert result(spark, [], []) == [] and result(spark, [], [(1, 1, 1)]) == []


def test_runs_of_characters():
    """Every run inside a word, edges included, and no others."""

    def plain(text):
        text = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
        runs = [f" {w} "[i : i + n] for w in text.split(" ") if w for n in toxicity.RUNS for i in range(len(w) + 3 - n)]
        out = []
        for run in runs:
            code = 0 if run[0] == " " else ord(run[0])
            for c in run[1:]:
                code = (code * 0x9E3779B97F4A7C15 + (0 if c == " " else ord(c))) % (1 << 64)
            out.append((((code ^ code >> 31) * 0xD6E8FEB86659FD93) % (1 << 64)) >> 64 - 19)
        return sorted(out)

    rng = random.Random(3)
    for text in ["", "a", "ab", "Ab1cd", "  é漢字 x\ny😀 ", "a-b_c", *("".join(rng.choice("aBç 1-\n") for _ in range(200)) for _ in range(50))]:
        assert sorted(np.concatenate([*toxicity.buckets(text), np.empty(0, np.int64)]).tolist()) == plain(text)
    long, whole = " ".join(["abcd efg"] * 40), toxicity.AT_ONCE
    toxicity.AT_ONCE = 7
    try:
        cut = np.concatenate(list(toxicity.buckets(long))).tolist()
    finally:
        toxicity.AT_ONCE = whole
    assert set(cut) == set(plain(long))


def test_risk():
    """The prior's share of the unlabelled texts is toxic: features of theirs are, the others' are not."""
    x = np.eye(4, dtype=np.uint8)[np.array([0] * 60 + [1] * 70)]
    positive, unlabelled = np.arange(130) < 30, np.arange(130) >= 30
    w = toxicity.trained(x, positive, unlabelled, prior=0.3, epochs=300)
    assert w[0] + w[-1] > 1 and w[1] + w[-1] < -1
    # with a prior too large the unlabelled part would fall without end; the maximum stops it
    w = toxicity.trained(x, positive, unlabelled, prior=0.5, epochs=300)
    assert w[0] + w[-1] > 1 and np.abs(w).max() < 20


def test_cut():
    toxic, other = np.arange(5.0, 9.0, 0.1), np.concatenate([np.arange(-5, 0, 0.05), np.arange(5.0, 9.0, 0.4)])
    assert 4 <= toxicity.cut(toxic, other, prior=0.1) <= 6
    assert toxicity.cut(np.zeros(5), np.zeros(50), prior=0.1) > 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in queries.op11_toxicity(spark, sf_dir).collect()}
    marks = duck(sf_dir).execute("SELECT doc_id, toxic FROM labels").fetchall()
    unseen = [(found[i]["score"], found[i]["predicted"], t) for i, t in marks if found[i]["held_out"]]
    toxic, other = [s for s, _, t in unseen if t], [s for s, _, t in unseen if not t]
    area = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in other])
    assert area > 0.95 and sum(p for _, p, t in unseen if t) > 0.6 * len(toxic) and sum(p for _, p, t in unseen if not t) < 0.02 * len(other)
