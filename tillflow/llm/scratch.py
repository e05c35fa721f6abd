"""Tables written between two steps of an operator, in the cluster's shared folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillflow.session import shared_folder
from tillflow.sinks import folders

_written: list[tuple[SparkSession, str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, removed when the driver ends."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here, and no lost executor matters.

    With ``by`` the rows of each value of that column are files of their own.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._scratch = path
    return found


def free(table: DataFrame) -> None:
    """Removes what ``stored`` has written for a table that nothing reads any more."""
    remove(table.sparkSession, table._scratch)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more."""
    folders.remove(spark, path)
    _written[:] = [w for w in _written if w[1] != path]


def remove_all() -> None:
    """Removes what this driver has written; results read from it must have been used by then."""
    while _written:
        spark, path = _written.pop()
        try:
            folders.remove(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended, or the folder's file system is out of reach; others may not be
            continue


atexit.register(remove_all)
