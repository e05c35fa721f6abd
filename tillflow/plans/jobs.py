"""The batch jobs: bronze, silver, gold, export, checks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators import cleaning, gold, quality, reports
from tillflow.operators.keyed import apply_retention, upsert
from tillflow.operators.staging import STAGING
from tillflow.plans import retention
from tillflow.schemas import ENTITIES, KEYS, WIRE
from tillflow.sinks import folders
from tillflow.sinks.curve import write_curve
from tillflow.sinks.tables import export_gold, export_manifest, write_silver, write_table
from tillflow.sources.files import find_silver, footer_session, read_entity_csv, read_silver, require_sources, text_csv, typed, with_file_order
from tillflow.streaming.jobs import await_all, ingest_bronze_append

RunTime = datetime | str | None

# Folders of a table stored by date.
DATE_FOLDERS = {
    "clickstream": ["event_year", "event_month"],
    "purchases": ["purchase_year", "purchase_month"],
    "customers": ["signup_year"],
}


def _csv_paths(source: str) -> dict[str, str]:
    return {entity: f"{source}/{entity}.csv" for entity in ENTITIES}


def load_bronze_full(spark: SparkSession, source: str, root: str) -> None:
    """Replace bronze by what the CSV files hold now."""
    paths = _csv_paths(source)
    require_sources(spark, paths)
    for entity, path in paths.items():
        write_table(read_entity_csv(spark, entity, path), f"{root}/{entity}")


# Attributes that silver tables are looked up by, besides the year, which has folders.
LOOKED_UP = {
    "clickstream": ["event_month", "session_id", "event_type", "product_id"],
    "purchases": ["purchase_month", "user_id", "product_id"],
    "customers": ["email_domain", "country"],
}


def write_lookups(spark: SparkSession, silver_root: str, root: str, entity: str, files: int | None = None) -> int:
    """A copy of a stored silver table that is looked up by any of its attributes: folders by year, files along a curve."""
    silver = read_silver(spark, silver_root, entity)
    return write_curve(silver, f"{root}/{entity}", LOOKED_UP[entity], DATE_FOLDERS[entity][:1], files)


def load_keyed(spark: SparkSession, source: str, root: str) -> None:
    """Replace the keyed tables by what the CSV files insert, line after line: the last line of a key wins."""
    paths = _csv_paths(source)
    require_sources(spark, paths)
    for entity, path in paths.items():
        lines = typed(with_file_order(text_csv(spark, entity, path)), entity, "file_order")
        write_table(upsert(lines, KEYS[entity], ["file_order"]).drop("file_order"), f"{root}/{entity}")


def remove_old(
    spark: SparkSession, path: str, time: str, as_of: RunTime, days: int = 7, folders_by: list[str] | None = None
) -> None:
    """Removes from the Parquet table at ``path`` the rows that are older than ``days`` days before ``as_of``.

    A table in date folders (``folders_by``: year, month, day or the first of
    them) loses old folders and has one rewritten, see ``retention``.  A table
    without folders has to be rewritten: what stays is written beside it and
    then takes its place.
    """
    if folders_by:
        retention.remove_old_folders(spark, path, folders_by, time, as_of, days)
        return
    kept = apply_retention(spark.read.parquet(path), time, as_of, days)
    work, old = f"{path}-kept-{uuid.uuid4().hex}", f"{path}-old-{uuid.uuid4().hex}"
    write_table(kept, work)
    folders.move(spark, path, old)
    folders.move(spark, work, path)
    folders.remove(spark, old)


def load_bronze_new(spark: SparkSession, source: str, root: str, checkpoints: str) -> None:
    """Append to bronze the files that arrived since the last run, from one folder per entity."""
    await_all(
        [
            ingest_bronze_append(
                spark, entity, f"{source}/{entity}", f"{root}/{entity}", f"{checkpoints}/{entity}_ingest", WIRE[entity]
            )
            for entity in ENTITIES
        ]
    )


def run_batch_silver(
    spark: SparkSession, source: str, root: str, run_ts: RunTime = None, fmt: str = "parquet", by_date: bool = False
) -> DataFrame:
    """CSV files to silver tables; returns their row counts, taken while the tables are written."""
    return batch_summary(spark, source, root, run_ts, fmt, by_date).groupBy("table").agg(F.first("records").alias("records"))


def batch_summary(
    spark: SparkSession, source: str, root: str, run_ts: RunTime = None, fmt: str = "parquet", by_date: bool = False
) -> DataFrame:
    """CSV files to silver tables; returns each table's rows, columns, types and filled values.

    All measures are observed in the tasks that write: no table is read again.
    """
    paths = _csv_paths(source)
    require_sources(spark, paths)
    found = []
    for entity, path in paths.items():
        df = cleaning.silver(entity, read_entity_csv(spark, entity, path), run_ts)
        seen = write_silver(df, root, entity, fmt, DATE_FOLDERS[entity] if by_date else None)
        found += [(entity, seen["rows"], i + 1, c, kind, seen[f"filled_{i}"]) for i, (c, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(found, "table string, records bigint, position int, column string, type string, filled bigint")


def staging_models(
    spark: SparkSession, silver_root: str, run_ts: RunTime = None, fmt: str = "parquet", entities: tuple[str, ...] = ENTITIES
) -> dict[str, DataFrame]:
    return {
        f"stg_{entity}": STAGING[entity](read_silver(spark, silver_root, entity, fmt), run_ts) for entity in entities
    }


def run_gold(
    spark: SparkSession, silver_root: str, gold_root: str, run_ts: RunTime = None, fmt: str = "parquet",
    entities: tuple[str, ...] = ENTITIES,
) -> dict[str, DataFrame]:
    """Silver to gold in order of dependence.

    Each model is written and read back before the next one uses it, so no
    model is computed twice and a lost executor costs one model's work at most.
    """
    models = staging_models(spark, silver_root, run_ts, fmt, entities)

    def store(name: str, df: DataFrame) -> DataFrame:
        write_table(df, f"{gold_root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{gold_root}/{name}")

    dim = store("dim_customers", gold.dim_customers(models["stg_customers"], models["stg_purchases"]))
    facts = store("fct_purchases", gold.fct_purchases(models["stg_purchases"], dim))
    daily = store("daily_sales_summary", gold.daily_sales_summary(facts, run_ts))
    return {**models, "dim_customers": dim, "fct_purchases": facts, "daily_sales_summary": daily}


def run_export(
    tables: dict[str, DataFrame], root: str, run_id: str, run_ts: RunTime = None, single_file: bool = False
) -> DataFrame:
    """Export the gold tables; the manifest is written beside them and returned."""
    folder = export_gold(tables, root, run_id, single_file)
    manifest = export_manifest(tables, run_ts)
    write_table(manifest, f"{folder}/manifest", "csv")
    return manifest


def run_silver_checks(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Presence and row count of each silver table; Parquet tables are counted by their footers."""
    session = footer_session(spark) if fmt == "parquet" else spark
    return quality.silver_presence(session, find_silver(session, root, fmt))


def validate(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The checks, and three reports to look at: best customers, daily trend, latest purchases."""
    return {
        "checks": run_checks(tables),
        "top_customers": reports.top_customers(tables["dim_customers"]),
        "daily_sales_trend": reports.daily_sales_trend(tables["daily_sales_summary"]),
        "recent_purchases": reports.recent_purchases(tables["fct_purchases"]),
    }


def run_checks(tables: dict[str, DataFrame], stop_on_failure: bool = False) -> DataFrame:
    checks = quality.run_checks(tables)
    if stop_on_failure:
        quality.require_passed(checks)
    return checks
