from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tillflow.llm import clustering

SCHEMA = "vec_id bigint, embedding array<float>"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(rows, count=8, rounds=10, seed=3):
    """k-means in Python's integers, every distance computed."""
    own = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(own, key=lambda r: (name(r[0]), r[1]))[:count]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    assign = lambda: [min((far(v, c), k) for k, c in enumerate(centroids)) for _, v in own]
    for _ in range(rounds):
        clusters = [k for _, k in assign()]
        for k in set(clusters):
            members = [v for (_, v), c in zip(own, clusters, strict=True) if c == k]
            centroids[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    last = assign()
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda k: sum(d for d, c in last if c == k)
    return sorted(((i, k, d, of(k), sum(d for d, _ in last), sha[k]) for (i, _), (d, k) in zip(own, last, strict=True)), key=repr)


def vectors(n, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(11, 64)) * scale
    return [(i, (centres[i % 11] + rng.normal(size=64) * scale / 3).astype(np.float32).tolist()) for i in range(n)]


def got(spark, rows, parts=5, **settings):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "'v' AS v", "2 AS cluster", "'x' AS x", "3 AS stats").repartition(parts)
    found = clustering.nearest(df, **settings)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("scale", [0.1, 900.0])
def test_against_plain_integers(spark, scale):
    # components of the second go beyond what doubles square exactly
    rows = vectors(250, 1, scale)
    if scale > 1:
        rows[3] = (3, [60_000.0] + rows[3][1][1:])
    assert got(spark, rows) == plain(rows)


def test_unusable_vectors_repeats_and_ties(spark):
    rows = vectors(60, 2)
    rows += [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [float("nan")] + [0.0] * 63), (106, [float("inf")] + [0.0] * 63)]
    rows += [rows[0], rows[1], (None, rows[2][1]), (None, rows[3][1]), (7, rows[9][1])] + [(200 + i, rows[4][1]) for i in range(40)]
    # equally near to two centroids
    rows += [(300 + i, [float(i % 2)] + [0.0] * 63) for i in range(6)] + [(310, [0.5] + [0.0] * 63)]
    assert got(spark, rows) == plain(rows)


def test_fewer_vectors_than_centroids_and_equal_ones(spark):
    rows = vectors(3, 3)
    assert got(spark, rows) == plain(rows)
    same = [(i, [0.25] * 64) for i in range(20)]
    assert got(spark, same) == plain(same) and {r[1] for r in got(spark, same)} == {0}


def test_empty_tables(spark):
    assert got(spark, []) == [] and got(spark, [(1, None)]) == []


def test_components_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="65536"):
        got(spark, [(1, [70_000.0] * 64)])


def test_drift_tightening_scans_less_than_full_drift(spark):
    rows = spark.createDataFrame(vectors(4000, 4, 0.2), SCHEMA)
    tight, full = clustering.clustered(rows), clustering.clustered(rows, geometric=False)
    assert tight.scans[0] == full.scans[0] == 4000
    assert sum(tight.scans[1:]) < sum(full.scans[1:]) < 4000 * len(full.scans[1:])
    assert (tight.centroids == full.centroids).all()


@given(st.integers(0, 1 << 30), st.floats(0, 4), st.floats(0, 4))
def test_no_point_of_the_sphere_comes_closer_than_the_loosening(seed, reach, drift):
    rng = np.random.default_rng(seed)
    centre, before, step = rng.normal(size=(3, 3))
    after = before + drift * step / np.linalg.norm(step)
    points = rng.normal(size=(400, 3))
    points = centre + reach * points / np.linalg.norm(points, axis=1, keepdims=True) * rng.random((400, 1)) ** 0.2
    most = (np.linalg.norm(points - before, axis=1) - np.linalg.norm(points - after, axis=1)).max()
    bound = clustering.loosening(centre, reach, before, after)
    assert most <= bound + 1e-9 and bound <= np.linalg.norm(after - before) + 1e-9


def test_loosening_is_less_than_the_drift_beside_the_line_and_negative_behind():
    before, after = np.array([10.0, 0.0]), np.array([10.0, 2.0])
    assert 0 < clustering.loosening(np.zeros(2), 1.0, before, after) < 0.4
    assert clustering.loosening(np.array([10.0, -20.0]), 1.0, before, after) < -1.9
    assert clustering.loosening(np.array([10.0, 20.0]), 1.0, before, after) == 2.0
