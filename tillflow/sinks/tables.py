"""Batch sinks: silver, gold, named tables, exports and their manifest."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.times import stamp
from tillflow.operators.quality import union_all

# What the manifest says about each gold table.
GOLD_TABLES = {
    "dim_customers": "Customer dimension table with purchase metrics",
    "fct_purchases": "Purchase fact table with transaction details",
    "daily_sales_summary": "Daily aggregated sales metrics",
}


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. One file only on request: it makes one task write everything."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the table at ``path``.

    With partition columns the rows are first rebalanced by them, so a partition
    gets few files and a large one is still written by several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, **measures: Column
) -> dict[str, object]:
    """As ``write_table``, and returns aggregates of the rows as they were written, with no further scan.

    ``rows`` is always among them.  They are observed behind the last shuffle, in
    the tasks that write, each of which counts once however often it is tried.
    """
    seen = Observation()
    shaped = df.hint("rebalance", *partition_by) if partition_by else df
    shaped = shaped.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()])
    writer = shaped.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return dict(seen.get)


def profile_measures(df: DataFrame) -> dict[str, Column]:
    """How many rows fill each column, for ``write_counted``."""
    return {f"filled_{i}": F.count(F.col(c)) for i, c in enumerate(df.columns)}


def write_silver(
    df: DataFrame, root: str, entity: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> dict[str, object]:
    """Replaces a silver table; returns its rows, and how many fill each column, as they were written."""
    return write_counted(df, f"{root}/{entity}", fmt, partition_by, **profile_measures(df))


def materialise(
    spark: SparkSession, df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0
) -> DataFrame:
    """Replace the named table and return it.

    Tables bucketed alike by their join key join without a shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return spark.table(name)


def export_gold(tables: dict[str, DataFrame], root: str, run_id: str, single_file: bool = False) -> str:
    """Every gold table as CSV under the run's own folder, which is returned."""
    folder = f"{root}/{run_id}"
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}", single_file)
    return folder


def export_manifest(tables: dict[str, DataFrame], run_ts: datetime | str | None = None) -> DataFrame:
    """Records per exported table, and a last row with the number of tables and all records."""
    counts = union_all(
        [
            df.agg(F.count("*").alias("records")).select(
                F.lit(name).alias("table"), "records", F.lit(GOLD_TABLES.get(name, "")).alias("description")
            )
            for name, df in tables.items()
        ]
    )
    # One more copy of each of these few rows carries the grand total.
    copies = counts.select(
        F.explode(F.array("table", F.lit("TOTAL"))).alias("table"), "records", "description"
    )
    return (
        copies.groupBy("table")
        .agg(
            F.sum("records").alias("records"),
            F.count("*").alias("tables"),
            F.when(F.col("table") != "TOTAL", F.max("description")).otherwise("All tables").alias("description"),
        )
        .withColumn("exported_at", stamp(run_ts))
    )
