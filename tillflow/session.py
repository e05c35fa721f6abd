"""Session settings and the shared folder that written intermediates go to."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

from tillflow.sinks import folders

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows of a state store costs a read per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.enabled": "false",
}


# Large writes are shuffled in steps of about so many rows, so that only one step's shuffle files lie on disk at a time.
STEP_ROWS = 32_000_000


def steps_of(rows: int) -> int:
    return max(1, -(-rows // STEP_ROWS))


def build_session(app_name: str, **extra: str) -> SparkSession:
    """A session with the library's settings; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times carry no zone and mean UTC, so the session has to agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it, with its file system.

    A path without a scheme lies on the default file system, as Spark itself
    takes it. Only a local master may do without the setting and gets a
    temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/") if "://" in folder or folder.startswith("file:/") else folders.qualified(spark, folder)
    if not (context.master.startswith("local[") or context.master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tillflow-")


_scratch: list[tuple[SparkSession, str]] = []


@atexit.register
def remove_scratch() -> None:
    """Removes all paths that ``scratch_path`` has given out; runs when the driver ends."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            folders.remove(spark, path)
        except Exception:  # noqa: BLE001 - the session has ended, and with it the way to its file system
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; no two calls return the same one. It goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streams.

    State partitions are fixed for the life of a checkpoint, so they follow the
    cores of the cluster and not the caller's batch setting.  What a batch does
    behind its stream has no state: its shuffles start from as many partitions
    as the caller asks for, and their files go when the batch's write ends, not
    when the driver happens to collect its garbage.
    """
    sibling = spark.newSession()
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql."):
            sibling.conf.set(key, value)
    state = max(4, spark.sparkContext.defaultParallelism)
    sibling.conf.set("spark.sql.shuffle.partitions", str(state))
    sibling.conf.set(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(state, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    )
    sibling.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return sibling
