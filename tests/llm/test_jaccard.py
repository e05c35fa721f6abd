from __future__ import annotations

import random

import numpy as np
import pytest

from tillflow.llm import jaccard
from tillflow.llm.components import components


def shingle_set(text):
    words = (text or "").encode().lower().split()
    w = min(5, len(words))
    return {tuple(words[i : i + w]) for i in range(len(words) - w + 1)} if words else set()


def roots(rows, percent=80):
    """The shingle set of each row, and the number of one row of its component."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    return sets, [find(a) for a in range(len(rows))]


def order(i):
    """A null key is larger than any other."""
    return i is None, i or 0


def plain(rows, percent=80):
    sets, root = roots(rows, percent)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(least.get(r, order(i)), order(i))
    back = lambda i: None if i[0] else i[1]
    return sorted(((i, len(s), back(least[r])) for (i, _), s, r in zip(rows, sets, root, strict=True)), key=repr)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    boiler = draw.choices(vocabulary, k=30)
    rows = []
    for family in range(30):
        base = draw.choices(vocabulary, k=draw.choice([4, 5, 9, 40, 90, 150])) + (boiler if family % 2 else [])
        for _ in range(draw.choice([1, 2, 3, 12])):
            words = list(base)
            for _ in range(draw.randrange(4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((draw.randrange(10_000), " ".join(w.upper() if draw.random() < 0.1 else w for w in words)))
    # a chain whose ends are not similar, and a large family of near copies
    chain = draw.choices(vocabulary, k=100)
    for k in range(12):
        rows.append((20_000 - k, " ".join(chain[5 * k : 5 * k + 60])))
    base = draw.choices(vocabulary, k=120)
    for k in range(150):
        words = list(base)
        words[draw.randrange(120)] = f"own{k}"
        rows.append((30_000 + k, " ".join(words)))
    return [*rows, (None, rows[0][1]), (None, "nothing like the others at all"), (5, None), (6, ""), (2**63 - 1, "text of the largest number there is"), (None, None), (6, " "), rows[1], rows[1], (rows[1][0], "other text with that number")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "HELD", 4000)
    monkeypatch.setattr(jaccard, "TREE_MEMBERS", 16)
    monkeypatch.setattr(jaccard, "SLICE_SHINGLES", 1500)
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 4000)
    monkeypatch.setattr(jaccard, "COMMON_FROM", 20)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS class", "'x' AS tag", "3 AS n", "4 AS kind").repartition(4)
    got = jaccard.similar(df).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == plain(rows)
    stay = [(r["doc_id"], r["text_print"], r["component_id"]) for r in got if r["stays"] and r["n_shingles"]]
    assert len({c for *_, c in stay}) == len({(c) for _, n, c in plain(rows) if n})
    assert all(i == c for i, _, c in stay)


def test_very_long_texts_and_one_text_in_a_third_of_all_rows(spark):
    draw = random.Random(6)
    long = [draw.choice("abcdefghij") + str(draw.randrange(50_000)) for _ in range(200_000)]
    near = list(long)
    for _ in range(3_000):
        near[draw.randrange(len(near))] = "other"
    rows = [(1, " ".join(long)), (2, " ".join(near)), (3, "word " * 300_000), (4, "word " * 7)]
    rows += [(10 + i, f"one text that very many rows hold {i % 2 * 'in two forms'}") for i in range(200)] + [(9, "the very same row")] * 150
    got = jaccard.similar(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == plain(rows)


def test_empty_table(spark):
    assert jaccard.similar(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_tree_finds_all_that_may_be_similar():
    draw = np.random.default_rng(4)
    counts = draw.poisson(3, (700, jaccard.GROUPS))
    counts[350:] = np.maximum(counts[:350] + draw.integers(-1, 2, (350, jaccard.GROUPS)) * (draw.random((350, jaccard.GROUPS)) < 0.2), 0)
    points = np.column_stack([counts.sum(axis=1), counts])
    tree = jaccard.Tree(points)
    for q in points[::7]:
        shared = np.minimum(points[:, 1:], q[1:]).sum(axis=1)
        fits = jaccard.enough(q[0], points[:, 0], shared, 80) & (100 * points[:, 0] >= 80 * q[0]) & (100 * q[0] >= 80 * points[:, 0])
        assert sorted(tree.search(q, 80).tolist()) == np.flatnonzero(fits).tolist()


def test_connected_components(spark):
    draw = random.Random(9)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = sorted((x, find(x)) for x in list(root) if find(x) != x)
    for few in (0, 1000):
        assert sorted(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint"), few).collect())) == want


def test_members_of_the_main_component_need_not_ask():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randrange(2, 30)
        pairs = {(draw.randrange(n), draw.randrange(n)) for _ in range(draw.randrange(40))}
        near = [[b for a, b in pairs if a == k] + [a for a, b in pairs if b == k] for k in range(n)]
        # some share a root already; of these one group never asks
        roots = np.array([draw.randrange(n) for _ in range(n)])
        _, labels = np.unique(roots, return_inverse=True)
        asks = labels != labels[0] if draw.random() < 0.5 else np.ones(n, bool)
        asked = []
        got = jaccard.hanging(labels, asks, lambda k: asked.append(k) or np.array(near[k], np.int64))
        want = labels.copy()
        for a, b in pairs:
            if asks[a] or asks[b]:
                want[want == want[b]] = want[a]
        assert len({*zip(got.tolist(), want.tolist(), strict=True)}) == len(set(got.tolist())) == len(set(want.tolist()))
        assert len(asked) == len(set(asked))


def test_hub_of_a_large_group_is_found_with_few_questions():
    asked = []
    labels = jaccard.hanging(np.arange(2000), np.ones(2000, bool), lambda k: asked.append(k) or np.arange(2000))
    assert len(set(labels.tolist())) == 1 and len(asked) == 1
