"""k-means whose bounds loosen by geometric drift.

Every vector carries an upper bound of the distance to its own centroid and a
lower bound of that to all others.  When centroids have moved, the upper bound
grows by the own centroid's drift.  The lower bound need not shrink by the full
drift of the others: all vectors of a cluster lie in a sphere around its old
centroid, and the distance from a point x to a centroid that moves from p to q
shrinks by at most |pq| cos(a), with a the angle at the middle of pq between its
direction and x.  In the plane of the sphere's centre and the line pq the least
angle of the sphere's points follows from its radius (``loosening``).  Where
the bounds still separate, the assignment stands; other vectors compute the
exact distance to their centroid, and those still in doubt all distances.

Components are integers, and all distances and sums that decide anything are
exact.  A round is a pass over a table that holds the vectors with their
bounds: no vector is shuffled, and the driver gets one row per cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import new_folder, remove

SIZE, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Components up to EXACT in size give squared distances that doubles hold exactly, up to LARGEST ones that fit a long.
EXACT, LARGEST = 1 << 22, 1 << 26
#: Bounds must be apart by this share of their sum, far more than doubles can be wrong by.
SLACK = 1e-9


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (points x centroids) of integer vectors."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def to_own(points: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Exact squared distance of each point to the centroid of its cluster."""
    return ((points - centroids[cluster]) ** 2).sum(axis=1)


def loosening(centre: np.ndarray, reach: float, before: np.ndarray, after: np.ndarray) -> float:
    """The most that the distance to a centroid moving from ``before`` to ``after`` shrinks for any point of a sphere.

    Never more than the drift; negative where the centroid moves away from all of the sphere.
    """
    drift = float(np.linalg.norm(after - before))
    if drift == 0:
        return 0.0
    to_centre = centre - (before + after) / 2
    away = float(np.linalg.norm(to_centre))
    if reach >= away:
        return drift
    angle = np.arccos(np.clip(to_centre @ (after - before) / (away * drift), -1, 1)) - np.arcsin(reach / away)
    if angle <= 0:
        return drift
    cosine = float(np.cos(angle))
    if cosine >= 0:
        return drift * cosine
    nearest = away - reach
    return drift * cosine * nearest / float(np.hypot(nearest, drift / 2))


@dataclass
class Move:
    """The centroids that a round assigns to, and how much bounds change since the round before."""

    centroids: np.ndarray
    grows: np.ndarray  # of a cluster's upper bounds
    shrinks: np.ndarray  # of a cluster's lower bounds, by the largest loosening among the other centroids


def move(before: np.ndarray, after: np.ndarray, reach: np.ndarray, geometric: bool = True) -> Move:
    """Bounds' changes; without ``geometric`` by the full drift of the others."""
    b, a = before.astype(np.float64), after.astype(np.float64)
    drift = np.linalg.norm(a - b, axis=1)
    loose = lambda i, j: loosening(b[i], reach[i], b[j], a[j]) if geometric else drift[j]
    shrinks = [max((loose(i, j) for j in range(len(a)) if j != i), default=0.0) for i in range(len(a))]
    return Move(after, drift * (1 + SLACK), np.array(shrinks) + SLACK * drift.max(initial=0))


def scanned(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, upper, lower) by all distances; of equally near centroids the one with the smaller number."""
    d = squared(points, centroids)
    cluster = d.argmin(axis=1)
    at = np.arange(len(points)), cluster
    upper = np.sqrt(d[at].astype(np.float64))
    others = d.astype(np.float64)
    others[at] = np.inf
    return cluster, upper, np.sqrt(others.min(axis=1))


def reassigned(points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, to: Move) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower, vectors whose distances were all computed) after the centroids moved."""
    upper, lower, cluster = upper + to.grows[cluster], lower - to.shrinks[cluster], cluster.copy()
    apart = lambda: upper + SLACK * (1 + upper + np.abs(lower)) < lower
    doubt = np.flatnonzero(~apart())
    upper[doubt] = np.sqrt(to_own(points[doubt], to.centroids, cluster[doubt]).astype(np.float64))
    doubt = doubt[~apart()[doubt]]
    if len(doubt):
        cluster[doubt], upper[doubt], lower[doubt] = scanned(points[doubt], to.centroids)
    return cluster, upper, lower, len(doubt)


def finite(vectors: Column) -> Column:
    """Whether a vector has exactly SIZE components, none null, NaN or infinite."""
    good = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vectors) == SIZE) & good, F.lit(False))


def kept(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x): the usable vectors, as doubles."""
    rows = table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("x"))
    return rows.where(finite(F.col("x")))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x)."""
    scaled = np.floor(SCALE * x.reshape(-1, SIZE))
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component beyond +-{LARGEST // SCALE}: squared distances would not fit a long")
    return scaled.astype(np.int64)


def first_centroids(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed:key, then the smallest components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    chosen = rows.orderBy(name, "x").limit(count).select("x").collect()
    return whole(np.array([r["x"] for r in chosen], np.float64))


STATE = "v binary, cluster int, upper double, lower double, stats array<struct<cluster:int,n:bigint,scans:bigint,reach:double,sums:array<bigint>>>"
STATS = pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("scans", pa.int64()), ("reach", pa.float64()), ("sums", pa.list_(pa.int64()))]))


def round_of(table: DataFrame, to: Move, path: str) -> DataFrame:
    """Assigns all vectors and writes them with their bounds; the first row of every batch holds its sums by cluster.

    ``table`` has vectors (key, x) at first, later what a round has written.
    """
    first = "x" in table.columns
    kind = table.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                points = whole(batch.column("x").flatten().to_numpy(zero_copy_only=False))
                cluster, upper, lower = scanned(points, to.centroids)
                scans = len(points)
            else:
                points = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.int32).reshape(-1, SIZE).astype(np.int64)
                cluster, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower"))
                cluster, upper, lower, scans = reassigned(points, cluster.astype(np.int64), upper, lower, to)
            sums = []
            for i in np.unique(cluster).tolist():
                own = cluster == i
                sums.append({"cluster": i, "n": int(own.sum()), "scans": scans if not sums else 0, "reach": float(upper[own].max()), "sums": points[own].sum(axis=0).tolist()})
            v = points.astype(np.int32)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SIZE), len(v), [None, pa.py_buffer(v.tobytes())]).cast(pa.binary())
            columns = [batch.column("key"), packed, pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower), pa.array([sums] + [None] * (len(v) - 1), STATS)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "v", "cluster", "upper", "lower", "stats"])

    found = table.mapInArrow(task, f"key {kind}, {STATE}")
    found.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(found.schema).parquet(path)


@dataclass
class Sums:
    """Per cluster number: vectors, an upper bound of their distances, and sums of their components."""

    n: np.ndarray
    reach: np.ndarray
    sums: list[list[int]]
    scans: int


def summed(table: DataFrame, count: int) -> Sums:
    stats = table.where(F.col("stats").isNotNull()).select(F.inline("stats"))
    sums = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(SIZE)]
    rows = stats.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("scans").alias("scans"), F.max("reach").alias("reach"), *sums).collect()
    found = Sums(np.zeros(count, np.int64), np.zeros(count), [[0] * SIZE for _ in range(count)], sum(r["scans"] for r in rows))
    for r in rows:
        found.n[r["cluster"]], found.reach[r["cluster"]] = r["n"], r["reach"]
        found.sums[r["cluster"]] = [int(r[f"s{i}"]) for i in range(SIZE)]
    return found


@dataclass
class Clustering:
    """The last assignment (key, v, cluster, upper, lower, stats), its centroids, and the vectors scanned in each round."""

    table: DataFrame
    centroids: np.ndarray
    scans: list[int]


def clustered(table: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, geometric: bool = True) -> Clustering | None:
    """Exact k-means: ``rounds`` times all vectors are assigned and centroids replaced, then vectors are assigned once more.

    Vectors with another number of components than SIZE, or with a null or
    non-finite one, and null vectors are left out; None if none are left.  Rows
    that repeat a key or a vector count each.  A null key is hashed as the empty
    string.  Fewer vectors than ``count`` make fewer centroids.  Other columns
    are not read.  Components beyond +-65,536 raise an error.
    """
    spark = table.sparkSession
    rows = kept(table, key, vector)
    centroids = first_centroids(rows, count, seed)
    count = len(centroids)
    if not count:
        return None
    path = new_folder(spark, "clusters")
    state = round_of(rows, Move(centroids, np.zeros(count), np.zeros(count)), path)
    scans = []
    for _ in range(rounds):
        sums = summed(state, count)
        scans.append(sums.scans)
        after = np.array([[s // n for s in own] if n else c.tolist() for own, n, c in zip(sums.sums, sums.n.tolist(), centroids, strict=True)], np.int64)
        if (after == centroids).all():
            break  # nothing moves any more: the rounds that are left would all be the same
        old, path = path, new_folder(spark, "clusters")
        state = round_of(state, move(centroids, after, sums.reach, geometric), path)
        centroids = after
        remove(spark, old)
    return Clustering(state, centroids, scans)


def nearest(table: DataFrame, key: str = "vec_id", vector: str = "embedding", **settings) -> DataFrame:
    """One row per usable vector: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    found = clustered(table, key, vector, **settings)
    kind = table.schema[key].dataType.simpleString()
    if not found:
        schema = f"{key} {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return table.sparkSession.createDataFrame([], schema)
    centroids = found.centroids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.frombuffer(b"".join(batch.column("v").to_pylist()), np.int32).reshape(-1, SIZE).astype(np.int64)
            d = to_own(points, centroids, batch.column("cluster").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("cluster"), pa.array(d, pa.int64())], ["key", "cluster", "distance"])

    rows = found.table.select("key", "v", "cluster").mapInArrow(task, f"key {kind}, cluster int, distance bigint")
    totals = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    own = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))
    return rows.select(
        F.col("key").alias(key), "cluster", "distance", own([totals.get(i, 0) for i in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("bigint").alias("inertia"), own(shas, "string").alias("centroid_sha256"),
    )
