"""Latest row per key: the batch form of insert-as-upsert, and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.functions.times import stamp

Order = str | Column


def dedupe_latest(df: DataFrame, keys: list[str], order_by: list[Order]) -> DataFrame:
    """The last row of each key in ``order_by`` order, which should be total.

    Spark turns the filter on ``row_number`` into a group limit that also runs
    before the shuffle, so a key with many copies sends at most one row per
    task and no task receives them all.
    """
    latest_first = Window.partitionBy(*keys).orderBy(*[F.desc(o) if isinstance(o, str) else o.desc() for o in order_by])
    return df.withColumn("__rank", F.row_number().over(latest_first)).where("__rank = 1").drop("__rank")


def upsert(df: DataFrame, keys: list[str], order_by: list[Order]) -> DataFrame:
    """What a keyed table holds after inserting the rows one after the other.

    Rows without a full key cannot be stored under one and are left out.
    """
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return dedupe_latest(df, keys, order_by)


def merge_latest(current: DataFrame, changes: DataFrame, keys: list[str], order_by: list[Order]) -> DataFrame:
    """Keyed table ``current`` after inserting ``changes``; a change beats a stored row."""
    both = current.withColumn("__arrival", F.lit(0)).unionByName(changes.withColumn("__arrival", F.lit(1)))
    return upsert(both, keys, ["__arrival", *order_by]).drop("__arrival")


def apply_retention(df: DataFrame, time: str, as_of: datetime | str | None, days: int = 7) -> DataFrame:
    """Rows from the last ``days`` days before ``as_of``."""
    return df.where(F.col(time) >= stamp(as_of) - F.expr(f"INTERVAL {int(days)} DAYS"))
