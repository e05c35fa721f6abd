"""JSON message streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillflow.functions.times import parsed_time
from tillflow.schemas import TIME_FIELD, WIRE

# Column that says when a message arrived, next to its record.
ARRIVAL = "arrival"


def kafka_source(spark: SparkSession, topic: str, servers: str, starting: str = "earliest", **options: str) -> DataFrame:
    """One topic as a stream of messages. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return reader.options(**options).load()


def folder_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files, one JSON message per line, as a stream of messages.

    They arrive in the order of their files' times and of the files' splits; lines of a split keep their order.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata")
    place = F.struct(file["file_modification_time"], file["file_path"], file["file_block_start"])
    return reader.text(path).select("value", place.alias(ARRIVAL))


def decode_json(messages: DataFrame, entity: str) -> DataFrame:
    """The record in each message's ``value``, and its ``arrival``: what sorts messages as they came.

    Text that is no JSON object gives a record of nulls, which the silver rules
    remove.  A time that cannot be read becomes null.  Messages of a topic
    arrive by time, partition and offset; those without any place have no
    ``arrival`` column.
    """
    if {"partition", "offset", "timestamp"} <= set(messages.columns):
        messages = messages.withColumn(ARRIVAL, F.struct("timestamp", "partition", "offset"))
    data = F.from_json(F.col("value").cast("string"), WIRE[entity]).alias("data")
    place = [ARRIVAL] if ARRIVAL in messages.columns else []
    decoded = messages.select(data, *place).select("data.*", *place)
    name = TIME_FIELD[entity]
    return decoded.withColumn(name, parsed_time(decoded, name))


#: Columns that ``decode_checked`` adds: the text of a message that could not be read, and what is wrong with it.
RAW, FAULT = "raw", "fault"


def decode_checked(messages: DataFrame, entity: str) -> DataFrame:
    """As ``decode_json``, and keeps what cannot be read: its text in ``raw``, and in ``fault`` what is wrong with it.

    ``message missing``     a message without value
    ``message unreadable``  text that is no JSON object with a field of the record
    ``field unreadable``    an object with a field that does not fit its type; the other fields are read
    """
    corrupt = "__corrupt"
    schema = StructType([*WIRE[entity].fields, StructField(corrupt, StringType())])
    text = F.col("value").cast("string")
    if {"partition", "offset", "timestamp"} <= set(messages.columns):
        messages = messages.withColumn(ARRIVAL, F.struct("timestamp", "partition", "offset"))
    data = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    place = [ARRIVAL] if ARRIVAL in messages.columns else []
    read = messages.select(text.alias("__text"), data.alias("data"), *place)
    some = reduce(Column.__or__, [F.col(f"data.{f.name}").isNotNull() for f in WIRE[entity].fields])
    fault = (
        F.when(F.col("__text").isNull(), "message missing")
        .when(F.col(f"data.{corrupt}").isNotNull() & some, "field unreadable")
        .when(F.col(f"data.{corrupt}").isNotNull() | ~some, "message unreadable")
    )
    decoded = read.select(
        *[F.col(f"data.{f.name}").alias(f.name) for f in WIRE[entity].fields],
        F.when(fault.isNotNull(), F.col("__text")).alias(RAW), fault.alias(FAULT), *place,
    )
    name = TIME_FIELD[entity]
    return decoded.withColumn(name, parsed_time(decoded, name))


def read_entity_stream(spark: SparkSession, entity: str, servers: str, topic: str | None = None, starting: str = "latest") -> DataFrame:
    """One entity's decoded records from its topic."""
    return decode_json(kafka_source(spark, topic or entity, servers, starting), entity)
