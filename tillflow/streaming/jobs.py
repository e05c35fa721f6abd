"""The two streaming jobs: medallion layers, and windowed analytics."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillflow.operators.analytics import clickstream_analytics, customer_analytics, purchase_analytics
from tillflow.operators.cleaning import message_quarantine, stream_filter
from tillflow.operators.keyed import Order
from tillflow.schemas import ENTITIES, KEYS, TIME_FIELD
from tillflow.session import steps_of
from tillflow.sinks import folders
from tillflow.sources.messages import ARRIVAL, decode_checked
from tillflow.streaming.sinks import (
    batch_folder, commit, held, latest_numbered, numbered, started, stream_snapshot, stream_to_files, stream_upsert, write_steps,
)
from tillflow.streaming.windows import start_windows

# Trigger of each layer's query; the keyed copies run as fast as possible.
TRIGGERS = {
    ("bronze", "clickstream"): "4 minutes",
    ("bronze", "purchases"): "4 minutes",
    ("bronze", "customers"): "30 seconds",
    ("silver", "clickstream"): "4 minutes",
    ("silver", "purchases"): "30 seconds",
    ("silver", "customers"): "30 seconds",
}
ANALYTICS_TRIGGER = "1 minute"


def start_medallion(
    streams: dict[str, DataFrame], root: str, checkpoints: str,
    trigger: str | None = None, order_by: dict[str, list[str]] | None = None,
) -> list[StreamingQuery]:
    """Bronze, keyed and silver copies of each entity's stream: nine queries.

    ``trigger`` replaces the trigger of all of them.  Of the rows of a key, the
    one that arrived last stays: by the stream's ``arrival`` column, or by
    ``order_by``.
    """
    queries = []
    for entity in ENTITIES:
        stream = streams[entity]
        last = (order_by or {}).get(entity) or [c for c in stream.columns if c == ARRIVAL]
        record = [c for c in stream.columns if c != ARRIVAL]

        def when(layer: str) -> str | None:
            return trigger or TRIGGERS.get((layer, entity))

        def places(layer: str) -> tuple[str, str]:
            return f"{root}/{layer}/{entity}", f"{checkpoints}/{entity}_{layer}"

        queries.append(stream_to_files(stream.select(record), *places("bronze"), when("bronze"), name=f"{entity}_bronze"))
        queries.append(
            stream_upsert(stream, KEYS[entity], last, *places("keyed"), when("keyed"), f"{entity}_keyed", record)
        )
        kept = stream_filter(entity, stream.select(record))
        queries.append(stream_to_files(kept, *places("silver"), when("silver"), name=f"{entity}_silver"))
    return queries


def start_layers(
    entity: str, stream: DataFrame, root: str, checkpoint: str, order_by: list[Order] | None = None, trigger: str | None = None
) -> StreamingQuery:
    """All three copies of one entity in one query, so its topic is read once and not three times.

    A batch is stored once with the order in which its rows arrived, the keyed
    copy is made of that in steps by key, and the silver copy of the bronze one.
    Every copy of a batch has a folder of its own: a batch that runs again
    replaces its files, whichever of the copies had been written.  Once all are,
    the batch is marked; ``read_committed`` shows marked batches only.
    """
    last = order_by or [c for c in stream.columns if c == ARRIVAL]
    if not last:
        raise ValueError("a keyed copy needs the order in which rows arrive")
    record = [c for c in stream.columns if c != ARRIVAL]

    def write(batch: DataFrame, batch_id: int) -> None:
        work, keys = f"{checkpoint}/held/{batch_id}", KEYS[entity]
        bronze, keyed, silver = (batch_folder(batch, f"{root}/{layer}/{entity}", batch_id) for layer in ("bronze", "keyed", "silver"))
        rows, seen = held(numbered(batch), work)
        write_steps([rows.select(record)], bronze)
        steps = steps_of(seen["rows"])
        step = F.pmod(F.xxhash64(*keys), F.lit(steps))
        parts = [rows.where(step == i) for i in range(steps)] if steps > 1 else [rows]
        write_steps([latest_numbered(part, keys, last).select(record) for part in parts], keyed)
        folders.remove(batch.sparkSession, work)
        stored = batch.sparkSession.read.schema(batch.select(record).schema).parquet(bronze)
        write_steps([stream_filter(entity, stored)], silver)
        commit(batch, root, entity, batch_id)

    return started(stream, write, checkpoint, trigger, f"{entity}_layers")


def start_quarantine(
    entity: str, messages: DataFrame, root: str, checkpoints: str, trigger: str | None = None
) -> StreamingQuery:
    """Keeps the messages that can't be read, with their text, and the records that fail a rule, with its name."""
    rejected = message_quarantine(entity, decode_checked(messages, entity))
    return stream_to_files(rejected, f"{root}/quarantine/{entity}", f"{checkpoints}/{entity}_quarantine", trigger, name=f"{entity}_quarantine")


def start_analytics(
    streams: dict[str, DataFrame], root: str, checkpoints: str,
    trigger: str | None = ANALYTICS_TRIGGER, fmt: str = "parquet", distinct: str = "exact",
    run_ts: datetime | str | None = None,
) -> list[StreamingQuery]:
    """Windowed clickstream and purchase measures, and the country snapshot."""

    def places(name: str) -> tuple[str, str]:
        return f"{root}/{name}", f"{checkpoints}/{name}"

    def windows(entity: str, measure: Callable[[DataFrame], DataFrame], name: str) -> StreamingQuery:
        return start_windows(streams[entity], TIME_FIELD[entity], measure, *places(name), trigger, fmt, name)

    countries = customer_analytics(streams["customers"], run_ts)
    return [
        windows("clickstream", lambda rows: clickstream_analytics(rows, run_ts, distinct), "clickstream_analytics"),
        windows("purchases", lambda rows: purchase_analytics(rows, run_ts), "purchase_analytics"),
        stream_snapshot(countries, *places("customer_analytics"), trigger, "customer_analytics"),
    ]


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; the first failure stops the rest and is raised."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(1)]
    finally:
        for query in waiting:
            query.stop()


def ingest_bronze_append(
    spark: SparkSession, entity: str, source: str, path: str, checkpoint: str, schema: StructType
) -> StreamingQuery:
    """Append the CSV files that are new since the last run; each file once."""
    arrivals = spark.readStream.schema(schema).option("header", True).csv(source)
    return stream_to_files(arrivals, path, checkpoint, "once through", name=f"{entity}_ingest")
