"""Connected components by alternating large and small stars, each step a written table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .scratch import free, stored

#: So many edges or fewer (16 bytes each) are finished by one task.
FEW = 1_000_000


def is_forest(edges: DataFrame) -> bool:
    """Whether every node but the roots has one edge, to a root that has none upwards."""
    split = edges.groupBy("high").agg(F.count("*").alias("n")).where("n > 1").select("high")
    chained = edges.join(edges.select(F.col("high").alias("low")), "low", "left_semi").select("high")
    return split.union(chained).isEmpty()


def large_star(edges: DataFrame) -> DataFrame:
    """Every node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select("low", "high"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("high"), "low").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node ties its smaller neighbours and itself to the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    tied = edges.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return tied.union(least.select("high", "least")).distinct()


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An edge to the least node of its component for every other node of the edges of a task."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(batch.column("high").to_pylist(), batch.column("low").to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    nodes = [x for x in root if find(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["high", "low"])


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """(node, root) of all nodes of links (a, b) that are not the least of their component."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    while True:
        if edges.count() <= few:
            next_, done = edges.coalesce(1).mapInArrow(lean(stars), "high bigint, low bigint"), True
        elif is_forest(edges):
            break
        else:
            next_, done = small_star(large_star(edges)), False
        before, edges = edges, stored(next_, "edges")
        free(before)
        if done:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
