"""Equi-joins in which one key may hold a large share of the rows.

Adaptive execution splits a hot partition only where both join inputs come
straight from a shuffle, and for an outer join only on the outer side.  The
gold joins have an aggregate or another join on their right, so they spread
their hot keys themselves.  A hot key's rows on one side are dealt over several
slices, and its rows on the other side are repeated once per slice.  All other
keys keep one slice and cost nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A slice is at most this part of an average shuffle partition.
SLICES_PER_PARTITION = 4
NULL_SLICES = 4096


def slice_count(df: DataFrame) -> int:
    """How many slices a whole table is cut into."""
    return SLICES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, slices: int | None = None, name: str = "slices") -> DataFrame:
    """Keys with more rows than one slice, and the number of slices each is dealt over.

    With ``slices`` slices in all there are fewer hot keys than that, and they
    get fewer than twice that many slices together, however large the table is.
    So the result is always small enough to broadcast.
    """
    slices = slices or slice_count(df)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    share = F.col("rows") * slices / counts.agg(F.sum("rows")).scalar()
    return counts.where(share > 1).select(key, F.ceil(share).cast("int").alias(name))


def _dealt(df: DataFrame, name: str, parts: Column, by: list[str]) -> DataFrame:
    """Deals each row to one of its key's slices.

    Rows are dealt by content and input partition, never by their order: a task
    that runs again after an executor is lost has to deal them the same way.
    The partition keeps exact copies of a row from sharing one slice.
    """
    return (
        df.withColumn("__row", F.xxhash64(*by, F.spark_partition_id()))
        .withColumn(name, F.pmod("__row", parts).cast("int"))
        .drop("__row")
    )


def _repeated(df: DataFrame, name: str, parts: Column) -> DataFrame:
    """Repeats each row once per slice of its key."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), parts - 1)))


def _or_one(name: str) -> Column:
    return F.coalesce(name, F.lit(1))


def sliced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    deal_by: list[str] | None = None,
    slices: int | None = None,
    right_unique: bool = False,
    merged: bool = True,
) -> DataFrame:
    """``left.join(right, key, how)`` for inner, left, left_semi and left_anti.

    ``deal_by`` names columns that tell the left rows of one key apart.
    ``right_unique`` says that no key occurs twice on the right, which saves
    counting its keys; where one does, the join is right, but that key's rows on
    the right stay together.  Adaptive execution merges partitions by their
    compressed bytes, which for narrow rows makes tasks that sort gigabytes;
    without ``merged`` there are as many tasks as the session has shuffle partitions.
    """
    if how in ("left_semi", "left_anti"):
        right, right_unique = right.select(key).distinct(), True
    by = deal_by or left.columns
    many_left = F.broadcast(hot_keys(left, key, slices, "__left_parts"))
    on = [key, "__left_slice"]

    def on_left(df: DataFrame) -> DataFrame:
        parts = F.coalesce("__left_parts", F.when(F.col(key).isNull(), NULL_SLICES), F.lit(1))
        return _dealt(df.join(many_left, key, "left"), "__left_slice", parts, by).drop("__left_parts")

    def on_right(df: DataFrame) -> DataFrame:
        return _repeated(df.join(many_left, key, "left"), "__left_slice", _or_one("__left_parts")).drop("__left_parts")

    def spread(df: DataFrame) -> DataFrame:
        return df if merged else df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on)

    if right_unique:
        return spread(on_left(left)).join(spread(on_right(right)), on, how).drop("__left_slice")

    # Keys that are hot on the right have a match, so an inner join is theirs and
    # both of their sides can be cut: each cell of the grid of slices is one task's.
    many_right = F.broadcast(hot_keys(right, key, slices, "__right_parts"))
    plain = spread(on_left(left.join(many_right, key, "left_anti"))).join(
        spread(on_right(right.join(many_right, key, "left_anti"))), on, how
    )
    wide_left = _repeated(left.join(many_right, key), "__right_slice", F.col("__right_parts")).drop("__right_parts")
    wide_right = _dealt(
        right.join(many_right, key), "__right_slice", F.col("__right_parts"), right.columns
    ).drop("__right_parts")
    grid = on_left(wide_left).join(on_right(wide_right), [*on, "__right_slice"]).drop("__right_slice")
    return plain.unionByName(grid).drop("__left_slice")
