"""CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillflow.schemas import BRONZE, TIME_FIELD, WIRE, silver_schema


class SourceMissing(Exception):
    pass


def read_entity_csv(spark: SparkSession, entity: str, path: str, mode: str = "declared") -> DataFrame:
    """One entity's CSV files, which carry a header.

    ``declared``  the wire schema: times stay text for the silver rules to judge.
    ``inferred``  types guessed from the data, at the price of one more pass over it.
    ``typed``     bronze types: an empty or unreadable field becomes null.
    """
    reader = spark.read.option("header", True)
    if mode == "inferred":
        return reader.option("inferSchema", True).csv(path)
    if mode == "declared":
        return reader.schema(WIRE[entity]).csv(path)
    if mode != "typed":
        raise ValueError(f"unknown mode {mode!r}")
    return typed(text_csv(spark, entity, path), entity)


def text_csv(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """One entity's CSV files with every field as text."""
    text = StructType([StructField(f.name, StringType(), True) for f in BRONZE[entity]])
    return spark.read.option("header", True).schema(text).csv(path)


def typed(df: DataFrame, entity: str, *others: str) -> DataFrame:
    """Text fields as bronze types, null where they can't be read, and other columns as they are."""
    return df.select(
        *[
            F.try_to_timestamp(f.name).alias(f.name)
            if f.name == TIME_FIELD[entity]
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in BRONZE[entity]
        ],
        *others,
    )


def with_file_order(df: DataFrame, name: str = "file_order") -> DataFrame:
    """Adds each scanned row's place: file, offset of its split, row within the split.

    Sorting by it gives the order in which one reader would go through the
    files, so "the last line wins" means the same on any number of tasks.
    """
    row_in_task = F.monotonically_increasing_id()
    return df.withColumn(
        name, F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), row_in_task.alias("row"))
    )


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header alone."""
    return spark.read.option("header", True).csv(path).columns


def read_silver(spark: SparkSession, root: str, entity: str, fmt: str = "parquet") -> DataFrame:
    """A silver table; CSV part files are read with the silver schema."""
    reader = spark.read.schema(silver_schema(entity))
    if fmt == "csv":
        return reader.option("header", True).option("pathGlobFilter", "part-*.csv").csv(f"{root}/{entity}")
    return reader.parquet(f"{root}/{entity}")


def footer_session(spark: SparkSession) -> SparkSession:
    """A sibling session that answers counts, and least and largest numbers, of Parquet tables from their footers.

    Spark's second Parquet scan takes such aggregates over; the first reads and
    counts rows.
    """
    sibling = spark.newSession()
    first = sibling.conf.get("spark.sql.sources.useV1SourceList", "").split(",")
    sibling.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in first if name != "parquet"))
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return sibling


def stored_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Parquet tables to count by their footers; they belong to a session of their own."""
    session = footer_session(spark)
    return {name: session.read.parquet(path) for name, path in paths.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, on whichever file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def find_silver(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame | None]:
    """Each silver table, or None where its folder is missing."""
    return {
        entity: read_silver(spark, root, entity, fmt) if path_exists(spark, f"{root}/{entity}") else None
        for entity in TIME_FIELD
    }


def require_sources(spark: SparkSession, paths: dict[str, str]) -> None:
    """Stop before any work if an input is missing, and name all that are."""
    missing = [f"{name} ({path})" for name, path in paths.items() if not path_exists(spark, path)]
    if missing:
        raise SourceMissing("missing sources: " + ", ".join(missing))


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
