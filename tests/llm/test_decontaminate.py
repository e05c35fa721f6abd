from __future__ import annotations

import gc
import random
import weakref

from tillflow.llm import decontaminate as d


def grams(words, w):
    return {tuple(words[i : i + w]) for i in range(len(words) - w + 1)}


def plain(docs, items, percent=80):
    out = []
    for i, text in docs:
        words = (text or "").encode().lower().split()
        for k, item in items:
            own = (item or "").encode().lower().split()
            w = min(5, len(own))
            if own:
                n, shared = len(grams(own, w)), len(grams(own, w) & grams(words, w))
                if 100 * shared >= percent * n:
                    out.append((i, k, shared, n))
    return sorted(out, key=repr)


def corpus():
    draw = random.Random(5)
    text = lambda n: draw.choices([f"w{i}" for i in range(300)] + ["É", "x"], k=n)
    items = [(i, " ".join(text(draw.choice([1, 2, 4, 5, 6, 15, 40, 70])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "  "), (43, "rep " * 30), (None, "null key item of six words"), (3, items[3][1])]
    docs = []
    for i in range(200):
        words = text(draw.choice([0, 3, 30, 500]))
        for _ in range(draw.randrange(3)):
            item = (draw.choice(items)[1] or "").split()
            for _ in range(draw.randrange(3)):  # edits
                if item:
                    item[draw.randrange(len(item))] = "edited"
            at = draw.randrange(len(words) + 1)
            words[at:at] = [w.upper() for w in item] if draw.random() < 0.3 else item
        docs.append((i, draw.choice([" ", "\n ", "\t"]).join(words)))
    return [*docs, (None, items[20][1]), (7, None), (8, ""), docs[3], (9, "long " * 30000 + items[21][1])], items


def test_pairs(spark):
    docs, items = corpus()
    a = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS key", "2 AS item", "'t' AS item_id").repartition(5)
    b = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "3 AS key", "4 AS doc_id")
    want = plain(docs, items)
    assert len(want) > 50
    for block_chars in (d.BLOCK_CHARS, 400):
        assert sorted(map(tuple, d.contained(a, b, block_chars=block_chars).collect()), key=repr) == want
    clean = d.without_leaks(a, b, block_chars=400)
    assert clean.columns == a.columns
    leaky = {repr(i) for i, *_ in want}
    # judged row by row: rows that share an id don't share a verdict
    assert sorted(repr(r["doc_id"]) for r in clean.collect()) == sorted(repr(i) for i, t in docs if not plain([(i, t)], items)) and leaky


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert d.contained(docs, items).collect() == []
    assert d.without_leaks(docs, items).count() == 1
    assert d.contained(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_driver_holds_one_block_at_a_time(spark, monkeypatch):
    docs, items = corpus()
    alive, most = weakref.WeakSet(), []

    class Counted(d.Sketches):
        def __init__(self, *args):
            super().__init__(*args)
            gc.collect()
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(d, "Sketches", Counted)
    a, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for block_chars in (d.BLOCK_CHARS, 300):
        most.clear()
        assert d.contained(a, b, block_chars=block_chars).count() == len(plain(docs, items))
        assert d.without_leaks(a, b, block_chars=block_chars).count() < len(docs)
        # the one that was used last may still be there
        assert max(most) <= 3 and (block_chars > 300 or len(most) > 20)
