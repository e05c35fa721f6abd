"""Both ways to find repeated passages against a plain one."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import recompression, repeats, sparse_suffixes
from tillflow.llm.words import Fingerprints, shingles, window_prints
from tillflow.session import shared_folder

METHODS = [recompression, sparse_suffixes]


def plain(rows, width):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    order = lambda i: repeats.NULL_ID if i is None else i
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            name = tuple(w[k : k + width])
            first[name] = min(first.get(name, order(i)), order(i))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < order(i):
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "Ünï", "x.\x0b"]
    text = lambda n: draw.choices(vocabulary, k=n)
    passages = [text(draw.choice([9, 10, 11, 14, 30])) for _ in range(6)] + [["again"] * 25, ["on", "off"] * 15]
    rows = []
    for i in range(120):
        words = [w for _ in range(draw.randrange(4)) for w in text(draw.randrange(30)) + draw.choice(passages)]
        rows.append((i * 3 % 100, draw.choice([" ", "  ", "\n", "\t "]).join(words)))
    rows += [(None, " ".join(passages[0])), (7, None), (8, ""), (9, " "), (50, "again " * 400), (51, "again " * 40), rows[5], rows[5]]
    rows += [(200 + i, " ".join(passages[4] + [f"end{i}"])) for i in range(60)] + [(repeats.NULL_ID, " ".join(passages[1])), (-repeats.NULL_ID - 1, " ".join(passages[2]))]
    return rows


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, method, seed, monkeypatch):
    monkeypatch.setattr(repeats, "AT_ONCE", 500)
    monkeypatch.setattr(repeats, "HELD", 300)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS id", "'x' AS name", "2 AS tag", "3 AS kind").repartition(7)
    assert result(method.without_repeats(df, width=10)) == plain(rows, 10)


@pytest.mark.parametrize("method", METHODS)
def test_texts_and_spans(spark, method):
    long = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, long), (2, f"before {long} after"), (3, "short")], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in method.without_repeats(df, with_text=True).collect()}
    assert got[1]["kept"] == long and got[1]["spans"] == []
    assert got[2]["kept"] == "before after" and [tuple(s) for s in got[2]["spans"]] == [(1, 61)]
    assert got[3]["kept"] == "short" and got[3]["n_removed"] == 0


@pytest.mark.parametrize("method", METHODS)
def test_empty_table(spark, method):
    assert method.without_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("method", METHODS)
def test_anchors_depend_on_the_window_alone(method):
    draw = random.Random(3)
    prints = Fingerprints()
    docs = [[b"%d" % draw.choice([1, 1, 2, 3, 4, 5, 6]) for _ in range(draw.randrange(80))] for _ in range(300)]
    docs += [[b"x"] * 100, [b"a", b"b"] * 40]
    h = np.concatenate([prints.of(d) for d in docs])
    starts, names = method.anchors(h, np.cumsum([len(d) for d in docs]), 12)
    flat, seen = [w for d in docs for w in d], {}
    assert len(starts) == sum(max(0, len(d) - 11) for d in docs)
    for s, n in zip(starts.tolist(), names.tolist(), strict=True):
        assert seen.setdefault(tuple(flat[s : s + 12]), n) == n


def test_window_prints():
    h = Fingerprints().of([b"%d" % (i % 9) for i in range(200)])
    got = window_prints(h, 9)
    assert len(set(got.tolist())) == 9 and (got[9:] == got[:-9]).all()
    assert len(shingles(h[:3], 5)) == 0 and len(window_prints(h[:3], 5)) == 0


def brute(suffixes, width):
    """Marked (id, tag, start) by comparing all windows of all suffixes as words."""
    windows = {}
    for s in suffixes:
        for k in range(len(s["words"]) - width + 1):
            windows.setdefault(tuple(s["words"][k : k + width]), []).append((s["id"], s["tag"], s["place"] + k))
    return sorted({w for same in windows.values() for w in same if w[0] > min(i for i, *_ in same)})


@pytest.mark.parametrize("seed", range(6))
def test_neighbours_are_extended_to_both_sides(seed):
    draw, width = random.Random(seed), 24
    order = sparse_suffixes.ORDER
    head = [draw.randrange(1 << 64) for _ in range(order)]
    pool = [draw.randrange(1 << 64) for _ in range(2)]
    suffixes = []
    for i in range(draw.randrange(2, 60)):
        at, after = draw.randrange(width - order + 1), draw.randrange(width - order + 1)
        if at + order + after < width:
            at = width - order - after
        side = lambda n: [draw.choice(pool) if draw.random() < 0.2 else pool[0] for _ in range(n)]
        h = np.array(side(at) + head + side(after), np.uint64)
        suffixes.append({"id": draw.randrange(20), "tag": i, "place": draw.randrange(100), "at": at, "words": h.tolist(), "data": sparse_suffixes.pack(h, width, 0, len(h) - width + 1)})
    suffixes.sort(key=lambda s: s["data"][s["at"] * sparse_suffixes.BYTES :])
    batch = sparse_suffixes.compared(suffixes, width)
    got = [(i, t, s) for i, t, d in zip(*(batch.column(c).to_pylist() for c in ("id", "tag", "data")), strict=True) for s in np.frombuffer(d, np.int32).tolist()]
    assert sorted(set(got)) == brute(suffixes, width)


def test_common_prefixes_and_packed_words():
    right = np.array([[1, 2, 3, 4], [1, 2, 3, 4], [1, 2, 9, 4], [5, 2, 9, 4], [5, 2, 9, 7]], np.uint64)
    assert sparse_suffixes.common_prefixes(right).tolist() == [0, 4, 2, 0, 3]
    h = np.array([1 << 63, (1 << 64) - 1, 12345 << 24], np.uint64)
    assert sparse_suffixes.unpack([sparse_suffixes.pack(h, 2, 0, 2), sparse_suffixes.pack(h, 2, 1, 1)]).tolist() == [int(x) >> 24 for x in (*h, *h[1:])]


def test_equal_windows_of_a_document_are_sent_once(spark):
    """A word repeated very often is one window, so that a run of equal suffixes stays small."""
    claims = repeats.Claims(50, sparse_suffixes.pack)
    h = np.repeat(Fingerprints().of([b"same"]), 100_000)
    one = window_prints(h, 50)
    starts = np.arange(len(one))
    claims.add({"id": 1, "tag": 2}, h, starts, one, starts, one, one.astype(np.uint32))
    kinds = [r["kind"] for r in claims.rows()]
    assert kinds == [repeats.ALIAS, repeats.CLAIM]
    rows = [(1, "same " * 300_000), (2, "x " + "same " * 200_000 + "y"), (3, "a b " * 100_000), (4, "b a " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for method in METHODS:
        got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in method.without_repeats(df).collect()}
        assert got == {1: (300_000, 0), 2: (200_002, 200_000), 3: (200_000, 0), 4: (120_000, 120_000)}


def test_words_of_one_kind_and_a_passage_in_a_third_of_all_documents(spark):
    draw = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*(f"own{i}.{k}" for k in range(draw.randrange(30))), *(passage if i % 3 == 0 else []), *draw.choices(["a", "b"], k=30)])) for i in range(300)]
    rows += [(1000, "same " * 5_000), (1001, "same " * 3_000), (1002, "x y " * 2_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(9)
    for method in METHODS:
        assert result(method.without_repeats(df, width=20)) == plain(rows, 20)


@pytest.mark.parametrize("bits", [repeats.FILTER_BITS, 1 << 15, 8])
def test_a_filter_misses_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(repeats, "FILTER_BITS", bits)
    rows = spark.range(20_000).select(F.col("id"), (F.col("id") * 7 - 9).alias("tag"), F.lit("x").alias("text"))
    got = repeats.likely(rows, rows.where("id % 50 = 0").select("tag", "id"), "id", "tag")
    assert got.columns == ["id", "tag", "text", "likely"]
    found = {r["id"]: r["likely"] for r in got.collect()}
    assert len(found) == 20_000 and all(found[i] for i in range(0, 20_000, 50))
    assert sum(found.values()) < 2_500 or bits == 8
    assert not any(r["likely"] for r in repeats.likely(rows, rows.where("id < 0"), "id", "tag").collect())


@pytest.mark.parametrize("method", METHODS)
def test_a_filter_too_small_changes_no_result(spark, method, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_BITS", 8)
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(method.without_repeats(df, width=10)) == plain(rows, 10)


@pytest.mark.parametrize("method", METHODS)
def test_texts_that_share_nothing_are_not_shuffled(spark, method, tmp_path):
    draw = random.Random(5)
    word = lambda: "%040x" % draw.getrandbits(160)
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(1_000)] + passage * (i % 100 == 0))) for i in range(400)]
    # written, so that the operator reads it without a shuffle
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).write.parquet(f"{tmp_path}/docs")
    folder = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    shuffled = lambda: set(glob.glob(f"{folder}/blockmgr-*/*/shuffle_*.data"))
    claims = lambda: set(glob.glob(f"{shared_folder(spark).removeprefix('file://')}/llm/claims-*/kind={repeats.CLAIM}"))
    before, claimed = shuffled(), claims()
    assert result(method.without_repeats(spark.read.parquet(f"{tmp_path}/docs"))) == plain(rows, 50)
    sizes = [os.path.getsize(p) for p in shuffled() - before]
    assert 0 < sum(sizes) < sum(len(t) for _, t in rows) / 4
    assert claims() == claimed
