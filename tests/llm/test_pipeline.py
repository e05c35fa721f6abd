"""The pipeline's stages, each on what the one before kept, against plain Python."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_decontaminate, test_exact, test_jaccard

STAGES = dict(corpus_pipeline.STAGES)
SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hard_rows():
    draw = random.Random(1)
    words = lambda n: " ".join(draw.choices([f"wort{i}" for i in range(90)], k=n))
    base = [words(60) for _ in range(6)]
    rows = [(i, draw.choice(base) + draw.choice(["", " ", "\n"]) + draw.choice(["", "ende"]), draw.choice(["de", None]), draw.choice(["s", None]), 1) for i in range(60)]
    rows += [(None, base[0], None, None, None), (None, None, None, None, None), (3, "", "de", "s", 0), (4, "%% 12", "de", "s", 5), rows[0], rows[0], (0, "another text with that number", "de", "s", 3)]
    return rows


@pytest.fixture(scope="module")
def benchmark_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]


@pytest.fixture(params=["given", "hard"])
def docs(spark, request):
    if request.param == "given":
        return spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return spark.createDataFrame(hard_rows(), SCHEMA).selectExpr("*", "'x' AS id", "1 AS class", "2 AS kept").repartition(3)


def test_language_id_keeps_what_has_letters(spark, docs):
    kept = STAGES["language_id"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    want = [r for r in rows_of(docs) if any(c.isalpha() for c in r[docs.columns.index("text")] or "")]
    assert rows_of(kept) == want


def test_exact_dedup(spark, docs):
    kept = STAGES["exact_dedup"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = test_exact.prints_of(spark, pairs)
    want = {(i, own) for i, _, _, stays, _, own in test_exact.plain(pairs, prints) if stays}
    got = [(r["doc_id"], prints[r["text"] or ""]) for r in kept.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_dedup_in_any_order(spark):
    rows = [(1, "a b c", "de", "s", 5), (1, "abc", "de", "s", 3), (2, "abc", "en", "s", 3), (4, "x", "fr", "s", 1), (4, "x", "de", "s", 1), (None, "x", None, None, None)]
    found = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        found.add(tuple(rows_of(STAGES["exact_dedup"](spark, spark.createDataFrame(order, SCHEMA).repartition(4), SF_DIR))))
    assert found == {((1, "a b c", "de", "s", 5), (4, "x", "de", "s", 1))}


def test_near_dedup(spark, docs):
    docs = docs.dropDuplicates(["doc_id", "text"])
    kept = STAGES["near_dedup"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # of every component one row stays, with the smallest key; components may share that key, as rows may share a doc_id
    sets, root = test_jaccard.roots(pairs)
    members = {}
    for pair, own, r in zip(pairs, sets, root, strict=True):
        members.setdefault(r if own else pair, []).append(pair)
    for group in members.values():
        stay = [p for p in group if p in got]
        assert len(stay) == 1 and test_jaccard.order(stay[0][0]) == min(test_jaccard.order(i) for i, _ in group)
    assert len(got) == len(members)


def test_decontamination(spark, docs, benchmark_rows):
    kept = STAGES["decontamination"](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    want = [r for r in docs.collect() if not test_decontaminate.plain([(r["doc_id"], r["text"])], benchmark_rows)]
    assert rows_of(kept) == sorted(map(tuple, want), key=repr)


def test_sentencepiece(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted(((r["doc_id"], model.encode(r["text"] or "")) for r in docs.collect()), key=repr)
    got = STAGES["sentencepiece"](spark, docs, SF_DIR).collect()
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == want


def test_run_against_all_stages_in_plain_python(spark, benchmark_rows):
    left = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert len({i for i, _ in left}) == len(left)
    left = [(i, t) for i, t in left if any(c.isalpha() for c in t or "")]
    stay = {i for i, _, _, kept, _, _ in test_exact.plain(left, test_exact.prints_of(spark, left)) if kept}
    left = [(i, t) for i, t in left if i in stay]
    stay = {i for i, n, c in test_jaccard.plain(left) if not n or i == c}
    left = [(i, t) for i, t in left if i in stay and not test_decontaminate.plain([(i, t)], benchmark_rows)]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((i, ids, model.decode(ids)) for i, ids in ((i, model.encode(t)) for i, t in left))
    got = entry.queries()["pipeline"](spark, SF_DIR)
    assert got.columns == ["doc_id", "ids", "decoded"]
    assert sorted((r["doc_id"], list(r["ids"]), r["decoded"]) for r in got.collect()) == want and 100 < len(want) < 200


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == [], name
