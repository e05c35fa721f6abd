"""Retention of tables stored in date folders: old folders go as a whole, one is rewritten, the others keep their files."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.sinks import folders

#: The folder of rows without a date, as Spark's writer names it.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def date_folders(spark: SparkSession, path: str, columns: list[str]) -> list[tuple[str, ...]]:
    """The values of ``columns`` that the table has folders for, as text; only names of folders are read."""
    found: list[tuple[str, ...]] = [()]
    for column in columns:
        start = f"{column}="
        found = [
            (*above, name[len(start) :])
            for above in found
            for name in folders.names(spark, _folder(path, columns, above))
            if name.startswith(start)
        ]
    return found


def _folder(path: str, columns: list[str], values: tuple[str, ...]) -> str:
    return "/".join([path, *(f"{c}={v}" for c, v in zip(columns, values))])


def span(values: tuple[str, ...]) -> tuple[datetime, datetime]:
    """First moment of a folder of a year, a month or a day, and first moment after it."""
    year, month, day = (*map(int, values), 1, 1)[:3]
    start = datetime(year, month, day)
    if len(values) == 1:
        return start, datetime(year + 1, 1, 1)
    if len(values) == 2:
        return start, datetime(year + month // 12, month % 12 + 1, 1)
    return start, start + timedelta(days=1)


def bound(as_of: datetime | date | str, days: int) -> datetime:
    """The time from which on rows stay."""
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    elif not isinstance(as_of, datetime):
        as_of = datetime.combine(as_of, datetime.min.time())
    return as_of - timedelta(days=days)


def remove_old_folders(
    spark: SparkSession, path: str, columns: list[str], time: str, as_of: datetime | date | str, days: int = 7, schema: StructType | None = None
) -> dict[str, int]:
    """Removes the rows whose ``time`` is more than ``days`` days before ``as_of``, and those without a time.

    ``columns`` are the table's folders: the year, month and day of ``time`` or
    the first one or two of these.  A folder that ends before the bound goes
    without being read.  The one folder that the bound falls in is read and
    replaced by dynamic partition overwrite, which swaps in that folder alone
    once its new files are complete.  All others are not touched.  Every step
    leaves a readable table and may be repeated, so a job that failed is run
    again.  Returns how many folders were removed, rewritten and left.
    """
    least = bound(as_of, days)
    done = {"removed": 0, "rewritten": 0, "left": 0}
    all_folders = date_folders(spark, path, columns)
    dated = [v for v in all_folders if NO_DATE not in v]
    for values in sorted((v for v in dated if span(v)[0] < least < span(v)[1]), key=span):
        rows = _of_folder(spark, path, columns, values, schema)
        kept = rows.where(F.col(time) >= F.lit(least).cast("timestamp"))
        if kept.isEmpty():
            folders.remove(spark, _folder(path, columns, values))
            done["removed"] += 1
        else:
            rewrite = kept.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            rewrite.partitionBy(*columns).parquet(path)
            done["rewritten"] += 1
    for values in [v for v in all_folders if NO_DATE in v] + sorted(v for v in dated if span(v)[1] <= least):
        folders.remove(spark, _folder(path, columns, values))
        done["removed"] += 1
    done["left"] = sum(span(v)[0] >= least for v in dated)
    return done


def _of_folder(spark: SparkSession, path: str, columns: list[str], values: tuple[str, ...], schema: StructType | None) -> DataFrame:
    """The rows of one folder, found by partition pruning."""
    rows = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for column, value in zip(columns, values):
        rows = rows.where(F.col(column) == int(value))
    return rows
