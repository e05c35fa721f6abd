"""Folders on whichever file system holds them; only names pass through the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, the default one if it names none."""
    system, folder = _open(spark, path)
    return system.makeQualified(folder).toString().rstrip("/")


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, in order; nothing if it is not there."""
    system, folder = _open(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _open(spark, path)
    return system.exists(folder)


def make(spark: SparkSession, path: str) -> None:
    system, folder = _open(spark, path)
    system.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _open(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    system, folder = _open(spark, path)
    _, target = _open(spark, to)
    system.mkdirs(target.getParent())
    if not system.rename(folder, target):
        raise OSError(f"{path} could not be moved to {to}")
