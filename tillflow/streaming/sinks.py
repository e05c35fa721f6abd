"""Streaming sinks.

Each query owns its checkpoint; started again on it, a query goes on where it
stopped and adds nothing twice.  A query on a new checkpoint counts its batches
from 0 again, so every store keeps the batches of each checkpoint apart:

    path/_generations/000001-<id of the query>
    path/generation=1/batch=0/part-...

The id is kept in the checkpoint.  The first batch of an id that the store
doesn't know opens the next generation; a batch that runs again replaces its
own folder.  Later generations are newer than all batches of earlier ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tillflow.operators.analytics import flatten_window
from tillflow.operators.keyed import Order, upsert
from tillflow.sinks import folders

# A processing-time interval such as "30 seconds", "once through" (all that is
# there, then stop), or None for batches as fast as possible.
ONCE_THROUGH = "once through"
# Generation of compacted tables: older than that of any stream.
COMPACTED = 0


def triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger is None:
        return writer
    if trigger == ONCE_THROUGH:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def generation(spark: SparkSession, path: str, query: str) -> int:
    """The number of a query's generation in a store; a query that is new to it gets the next one."""
    known = folders.names(spark, f"{path}/_generations")
    for name in known:
        number, _, owner = name.partition("-")
        if owner == query:
            return int(number)
    number = max((int(name.partition("-")[0]) for name in known), default=COMPACTED) + 1
    folders.make(spark, f"{path}/_generations/{number:06d}-{query}")
    return number


def batch_folder(batch: DataFrame, path: str, batch_id: int) -> str:
    """Where the batch that is being written belongs."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{path}/generation={generation(spark, path, query)}/batch={batch_id}"


def started(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None, name: str | None, mode: str = "append"
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, trigger).start()


def held(batch: DataFrame, folder: str, **measures: Column) -> tuple[DataFrame, dict[str, object]]:
    """A batch's rows, stored for as long as it is worked on, and aggregates of them; ``rows`` is always among these.

    So the source is read and decoded once, however many passes the work takes.  The caller removes the folder.
    """
    seen = Observation()
    rows = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()])
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder), dict(seen.get)


def write_steps(parts: list[DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Replaces a batch's folder by the rows of all parts, written one after the other; it is there once all are."""
    spark, (store, _, place) = parts[0].sparkSession, folder.rpartition("/generation=")
    to = folder if len(parts) == 1 else f"{store}/_steps-{place.replace('/batch=', '-')}"
    for i, part in enumerate(parts):
        writer = part.write.mode("append" if i else "overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(to)
    if to != folder:
        folders.remove(spark, folder)
        folders.move(spark, to, folder)


def stream_to_files(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, fmt: str = "parquet", name: str | None = None
) -> StreamingQuery:
    """Append to files. A window is written once, after the watermark has passed its end."""
    if "window" in df.columns:
        df = flatten_window(df)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_steps([batch], batch_folder(batch, path, batch_id), fmt)

    return started(df, write, checkpoint, trigger, name)


def read_batches(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """All rows of a store, of every generation."""
    reader = spark.read.schema(StructType([*schema.fields]).add("generation", "integer").add("batch", "long")).format(fmt)
    return reader.option("header", True).load(path).select(schema.names)


def latest(batch: DataFrame, keys: list[str], order_by: list[Order], columns: list[str] | None = None) -> DataFrame:
    """Of each key in a batch the row that arrived last; of equal places, the row that its task read last."""
    return latest_numbered(numbered(batch), keys, order_by).select(columns or batch.columns)


def numbered(batch: DataFrame) -> DataFrame:
    return batch.withColumn("__row", F.monotonically_increasing_id())


def latest_numbered(batch: DataFrame, keys: list[str], order_by: list[Order]) -> DataFrame:
    """As ``latest``, of rows that were numbered as their tasks read them."""
    return upsert(batch, keys, [*order_by, "__row"])


def stream_upsert(
    df: DataFrame, keys: list[str], order_by: list[Order], path: str, checkpoint: str,
    trigger: str | None = None, name: str | None = None, columns: list[str] | None = None,
) -> StreamingQuery:
    """Insert-as-upsert into a keyed table.

    A batch writes its latest row per key into its own folder, so its cost
    follows the batch and not the table.  ``order_by`` says which row of a key
    arrived last in a batch; ``columns`` are those that the table keeps.
    ``read_keyed`` picks each key's newest row.
    """
    if not order_by:
        raise ValueError("a keyed table needs the order in which rows arrive")

    def write(batch: DataFrame, batch_id: int) -> None:
        latest(batch, keys, order_by, columns).write.mode("overwrite").parquet(batch_folder(batch, path, batch_id))

    return started(df, write, checkpoint, trigger, name)


def _keyed(spark: SparkSession, path: str, batches: list[str] | None, schema: StructType, keys: list[str]) -> DataFrame:
    reader = spark.read.schema(StructType([*schema.fields]).add("generation", "integer").add("batch", "long"))
    found = reader.parquet(path) if batches is None else reader.option("basePath", path).parquet(*batches)
    return upsert(found, keys, ["generation", "batch"]).select(schema.names)


def read_keyed(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The keyed table as it stands: of each key, the row that arrived last."""
    return _keyed(spark, path, None, schema, keys)


def batches_of(spark: SparkSession, path: str) -> list[tuple[int, int, str]]:
    """(generation, batch, folder) of a store's finished batches, oldest first."""
    found = []
    for generation_ in folders.names(spark, path):
        if generation_.startswith("generation="):
            for batch in folders.names(spark, f"{path}/{generation_}"):
                folder = f"{path}/{generation_}/{batch}"
                if folders.exists(spark, f"{folder}/_SUCCESS"):
                    found.append((int(generation_.partition("=")[2]), int(batch.partition("=")[2]), folder))
    return sorted(found)


def commit(batch: DataFrame, root: str, entity: str, batch_id: int) -> None:
    """Marks a batch that has written all its copies below ``root``; the mark is a folder, which is there or is not."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    folders.make(batch.sparkSession, f"{root}/_committed/{entity}/{batch_id:012d}-{query}")


def committed_batches(spark: SparkSession, root: str, layer: str, entity: str) -> list[str]:
    """The folders of one copy whose batch has written all copies; what was compacted had."""
    path = f"{root}/{layer}/{entity}"
    marks = set(folders.names(spark, f"{root}/_committed/{entity}"))
    owners = {int(number): owner for number, _, owner in (name.partition("-") for name in folders.names(spark, f"{path}/_generations"))}
    return [folder for g, b, folder in batches_of(spark, path) if g == COMPACTED or f"{b:012d}-{owners.get(g)}" in marks]


def read_committed(spark: SparkSession, root: str, layer: str, entity: str, schema: StructType, keys: list[str] | None = None) -> DataFrame:
    """One copy as of the batches that are complete in all copies; with ``keys`` the newest row of each key.

    So the copies agree with each other, also while a batch is being written or after it has failed halfway.
    """
    path, batches = f"{root}/{layer}/{entity}", committed_batches(spark, root, layer, entity)
    if not batches:
        return spark.createDataFrame([], schema)
    if keys:
        return _keyed(spark, path, batches, schema, keys)
    whole = StructType([*schema.fields]).add("generation", "integer").add("batch", "long")
    return spark.read.schema(whole).option("basePath", path).parquet(*batches).select(schema.names)


def compact_keyed(spark: SparkSession, path: str, schema: StructType, keys: list[str], only: list[str] | None = None) -> int:
    """Folds the finished batches of a keyed table into one, in place; returns how many there were.

    ``only`` names the folders that may be folded, such as ``committed_batches``.

    The folded table takes its place first, older than every batch of a stream,
    and the batches go afterwards, oldest first: at every moment the newest row
    of a key is there, and a stream may write on.
    """
    old = [found for found in batches_of(spark, path) if only is None or found[2] in only]
    if not old:
        return 0
    work = f"{path}/_compaction-{uuid.uuid4().hex}"
    _keyed(spark, path, [folder for *_, folder in old], schema, keys).write.parquet(work)
    number = max((batch for g, batch, _ in old if g == COMPACTED), default=-1) + 1
    folders.move(spark, work, f"{path}/generation={COMPACTED}/batch={number}")
    for *_, folder in old:
        folders.remove(spark, folder)
    return len(old)


def stream_snapshot(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Keep the whole result of an unwindowed aggregate; the newest snapshot and the one before stay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(batch, path, batch_id))
        for *_, folder in batches_of(batch.sparkSession, path)[:-2]:
            folders.remove(batch.sparkSession, folder)

    return started(df, write, checkpoint, trigger, name, "complete")


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest finished snapshot, found by the folders' names."""
    *_, folder = batches_of(spark, path)[-1]
    return spark.read.schema(schema).parquet(folder)
