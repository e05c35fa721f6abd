from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import language

PARTS = {"aa": "an er in on re th the".split(), "bb": "äu öl sch ung ein der".split(), "cc": "qu oi eau ç é le".split()}


def text(lang, draw, n=40):
    return " ".join("".join(draw.choices(PARTS[lang], k=draw.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(1)
    rows = [(lang, text(lang, draw)) for lang in PARTS for _ in range(60)] + [(None, "x"), ("aa", None)]
    return language.fit(spark.createDataFrame(rows, "lang string, text string"))


def test_fit(model):
    assert model.languages == ["aa", "bb", "cc"]
    assert np.allclose(np.exp(model.logs.astype(float)).sum(axis=0), 1, atol=1e-3)


def test_a_language_of_one_row_is_one(spark):
    draw = random.Random(7)
    rows = [("aa", text("aa", draw)) for _ in range(50)] + [("dd", "wxyz zyxw wxwx yzyz")]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == ["aa", "dd"]
    got = language.identify(spark.createDataFrame([(1, "zyxw wxyz"), (2, text("aa", draw))], "doc_id bigint, text string"), model, "doc_id", "text").collect()
    assert {r["doc_id"]: r["language"] for r in got} == {1: "dd", 2: "aa"}


def test_labels_that_are_no_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LABELS", 3)
    with pytest.raises(ValueError, match="labels"):
        language.fit(spark.createDataFrame([(str(i), "x y") for i in range(5)], "lang string, text string"))


def plain(rows, model, fused=True):
    """{key: (language, probability, accepted)} of rows (key, text, declared, host, suffix), every count by hand."""
    n = len(model.languages)
    base, sums = [], {}
    for _, t, declared, host, suffix in rows:
        at = language.trigrams(t)
        own = model.logs[at].sum(axis=0, dtype=float) / (len(at) + language.STRENGTH) * language.STRENGTH if len(at) else np.zeros(n)
        own = own - own.max()
        base.append((len(at), own))
        if len(at):
            share = np.exp(own) / np.exp(own).sum()
            for name in (("all",), ("suffix", suffix or ""), ("host", host or "", suffix or ""), ("declared", declared or "")):
                sums[name] = sums.get(name, np.zeros(n)) + share
    overall = sums.get(("all",), np.zeros(n))
    top = (overall + 1) / (overall.sum() + n)
    values = max(sum(k[0] == "declared" for k in sums), 1)
    near = lambda own, parent, weight: (own + weight * parent) / (own.sum() + weight)
    out = {}
    for (key, _, declared, host, suffix), (length, logs) in zip(rows, base, strict=True):
        total = logs
        if fused:
            parent = near(sums.get(("suffix", suffix or ""), np.zeros(n)), top, language.SUFFIX_WEIGHT)
            at = ("host", host or "", suffix or "")
            total = total + np.log(near(sums[at], parent, language.HOST_WEIGHT) if at in sums else top)
            if ("declared", declared or "") in sums:
                total = total + np.log((sums["declared", declared or ""] + language.DECLARED_WEIGHT) / (overall + language.DECLARED_WEIGHT * values))
        p = np.exp(total - total.max())
        p /= p.sum()
        out[key] = (model.languages[p.argmax()], p.max(), length > 0 and p.max() >= 0.5)
    return out


def short_pages():
    """Pages of hosts that each write one language, many with too little text to tell; markup that declares it or another."""
    draw, rows = random.Random(9), []
    for h in range(12):
        own = list(PARTS)[h % 3]
        for i in range(25):
            words = draw.choice([0, 1, 1, 2, 30])
            body = text(own, draw, words) if words else draw.choice(["", "12 %", None])
            said = draw.choice([own, own, own, "zz", None])
            rows.append((100 * h + i, body, said, f"h{h}.example.{own}x", f"{own}x"))
    rows += [(9000, "r", "bb", "new.example.bbx", "bbx"), (9001, "e", None, None, None), (9002, "ö " * 100_000, "aa", "h0.example.aax", "aax"), (None, text("cc", draw), None, "", "")]
    return rows + [rows[3], rows[4]]


def as_page(row):
    key, body, said, host, _ = row
    markup = None if body is None else f"<html{f' lang={said}' if said else ''}><body><p>{body}</p>"
    return key, f"https://{host}/x" if host else host, markup


def test_pages_against_plain_counts(spark, model):
    rows = short_pages()
    pages = spark.createDataFrame([as_page(r) for r in rows], "page_id bigint, url string, html string").selectExpr("*", "1 AS key", "'x' AS host", "2 AS declared").repartition(4)
    html, url = F.col("html"), F.col("url")
    got = language.identify(pages, model, "page_id", language.visible_text(html), language.markup_language(html), language.host_of(url), language.suffix_of(url)).collect()
    seen = [(k, t, said if t is not None else None, host, suffix) for k, t, said, host, suffix in rows]
    want, alone = plain(seen, model), plain(seen, model, fused=False)
    assert len(got) == len(rows)
    for r in got:
        name, p, accepted = want[r["page_id"]]
        assert (r["language"], r["accepted"]) == (name, accepted) and r["probability"] == pytest.approx(p, rel=1e-6)
    own = {k: host.split(".")[2][:2] for k, _, _, host, _ in rows if host and k is not None}
    changed = [k for k in own if want[k][0] != alone[k][0]]
    better = sum(want[k][0] == own[k] for k in own) - sum(alone[k][0] == own[k] for k in own)
    assert len(changed) > 20 and better > 20


def test_held_out_accuracy_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = language.fit(docs.where(~held_out))
    # text alone: no declaration, one host
    found = language.identify(docs.where(held_out), model, "doc_id", "text").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["language"] == r["lang"] for r in found) >= 0.97 * len(found) and len(found) > 400


def test_evidence_is_fused(spark, model):
    draw = random.Random(2)
    rows = [(i, text("aa", draw), "aa", "h1") for i in range(40)] + [(100 + i, text("bb", draw), "bb", "h2") for i in range(40)]
    rows += [(200, "zzz", None, "h1"), (201, "zzz", None, "h2"), (202, "zzz", "bb", None), (203, text("cc", draw), "aa", "h1"), (204, None, "aa", "h1"), (205, "", None, None),
             (206, "1234 %%", "aa", "h1"), (None, text("bb", draw), None, None), (0, text("bb", draw), "bb", "h2")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").selectExpr("*", "1 AS key", "2 AS host", "'x' AS evidence").repartition(3)
    got = language.identify(df, model, "doc_id", "text", declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "language", "probability", "accepted", "n_trigrams"]
    found = {r["doc_id"]: (r["language"], r["accepted"]) for r in got}
    assert found[200][0] == "aa" and found[201][0] == "bb" and found[202][0] == "bb"
    assert found[203] == ("cc", True), "a long text outweighs its declaration and host"
    assert not found[204][1] and not found[205][1] and not found[206][1]
    assert found[None] == ("bb", True)


def test_probabilities_against_plain(spark, model):
    """One host without declarations: the posterior by hand."""
    draw = random.Random(3)
    texts = [text(draw.choice(list(PARTS)), draw, 3) for _ in range(30)]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model, "doc_id", "text").collect()}
    logs = []
    for t in texts:
        at = language.trigrams(t)
        own = model.logs[at].sum(axis=0, dtype=float) / (len(at) + language.STRENGTH) * language.STRENGTH
        logs.append(own - own.max())
    logs = np.array(logs)
    sums = (np.exp(logs) / np.exp(logs).sum(axis=1, keepdims=True)).sum(axis=0)
    prior = (sums + 1) / (sums.sum() + 3)
    for weight in (language.SUFFIX_WEIGHT, language.HOST_WEIGHT):
        prior = (sums + weight * prior) / (sums.sum() + weight)
    want = logs + np.log(prior) + np.log((sums + 1) / (sums + 1))
    want = np.exp(want) / np.exp(want).sum(axis=1, keepdims=True)
    for i in range(len(texts)):
        assert got[i]["probability"] == pytest.approx(want[i].max(), rel=1e-6)
        assert got[i]["language"] == model.languages[want[i].argmax()]


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify(
        pages, language.fit(docs), "page_id", language.visible_text(F.col("html")),
        language.markup_language(F.col("html")), language.host_of(F.col("url")), language.suffix_of(F.col("url")),
    )
    declared = pages.select("page_id", language.markup_language(F.col("html")).alias("declared"))
    rows = found.join(declared, "page_id").collect()
    assert len(rows) == 250 and sum(r["language"] == r["declared"] for r in rows) >= 240


def test_addresses(spark):
    rows = [("https://User@WWW.Example.ORG:8080/a?b", "www.example.org", "org"), ("no address", "", ""), (None, None, None)]
    df = spark.createDataFrame(rows, "url string, host string, suffix string")
    for r in df.select("*", language.host_of(F.col("url")).alias("h"), language.suffix_of(F.col("url")).alias("s")).collect():
        assert (r["h"], r["s"]) == (r["host"], r["suffix"])


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert language.identify(none, model, "doc_id", "text").collect() == []
    empty = language.fit(none)
    assert empty.languages == []
    (r,) = language.identify(spark.createDataFrame([(1, "some words")], "doc_id bigint, text string"), empty, "doc_id", "text").collect()
    assert r["language"] is None and not r["accepted"]


def test_rare_language_in_a_large_table(spark):
    """Which languages there are depends on their own rows, not on their share; one text in most rows fills no sample."""
    draw = random.Random(4)
    rows = [("cc", text("cc", draw)) for _ in range(25)] + [("aa", text("aa", draw)) for _ in range(3000)] + [("bb", text("bb", draw)) for _ in range(30)]
    copy = text("aa", draw)
    df = spark.createDataFrame(rows + [("bb", copy)] * 4000, "lang string, text string").repartition(5)
    model = language.fit(df, fit_rows=200)
    assert model.languages == ["aa", "bb", "cc"]
    labelled = df.select(F.col("text"), F.col("lang").alias("label"))
    shares = {"aa": 200 / 3000, "bb": 1.0, "cc": 1.0}
    found = [tuple(r) for r in language.sampled(labelled, shares).collect()]
    assert len(found) == len(set(found)) and {t for t, name in found if name == "bb"} == {t for name, t in rows if name == "bb"} | {copy}
    assert sum(name == "cc" for _, name in found) == 25 and 100 < sum(name == "aa" for _, name in found) < 320
    got = language.identify(spark.createDataFrame([(i, text("cc", draw)) for i in range(10)], "doc_id bigint, text string"), model, "doc_id", "text").collect()
    assert all(r["language"] == "cc" for r in got)


def test_query_of_pages_uses_markup_and_address(spark):
    import __spark_entry__ as entry

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = entry.queries()["op9_page_language_id"](spark, "/root/testdata/sf0.01")
    assert found.columns == ["page_id", "language", "probability", "kept", "n_trigrams"]
    declared = pages.select("page_id", language.markup_language(F.col("html")).alias("declared"))
    rows = found.join(declared, "page_id").collect()
    assert len(rows) == found.count() == pages.count() and sum(r["language"] == r["declared"] for r in rows) >= 240


def test_suffix_smooths_hosts(spark, model):
    """A host that is hardly known takes after the other hosts of its suffix."""
    draw = random.Random(5)
    rows = [(100 + i, text(name, draw), f"h{i}.example.{end}", end) for i in range(120) for name, end in [(("aa", "xa"), ("bb", "xb"))[i % 2]]]
    rows += [(1, "zzz", "new.example.xa", "xa"), (2, "zzz", "new.example.xb", "xb")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, host string, suffix string")
    got = {r["doc_id"]: r["language"] for r in language.identify(df, model, "doc_id", "text", host=F.col("host"), suffix=F.col("suffix")).where("doc_id < 3").collect()}
    assert got == {1: "aa", 2: "bb"}
