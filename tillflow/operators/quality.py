"""Data-quality checks.

A check is one row: its name, what was observed, what is expected, and PASS or
FAIL.  All row-level checks of a table share one scan.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.money import money_sum
from tillflow.functions.times import stamp
from tillflow.operators.skew import sliced_join
from tillflow.schemas import ENTITIES, SILVER_COLUMNS

# The columns that must be filled and the ones that must be unique.
NOT_NULL = [
    ("stg_customers", "customer_id"),
    ("stg_purchases", "order_id"),
    ("stg_purchases", "customer_id"),
    ("dim_customers", "customer_id"),
    ("fct_purchases", "order_id"),
    ("fct_purchases", "customer_id"),
    ("daily_sales_summary", "purchase_date"),
]
UNIQUE = [
    ("stg_customers", "customer_id"),
    ("stg_purchases", "order_id"),
    ("dim_customers", "customer_id"),
    ("fct_purchases", "order_id"),
    ("daily_sales_summary", "purchase_date"),
]


class ChecksFailed(Exception):
    pass


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def scan_checks(df: DataFrame, faults: dict[str, Column]) -> DataFrame:
    """Rows showing each fault, all counted in one pass."""
    names = list(faults)
    counts = df.agg(*[_count_where(faults[n]).alias(f"c{i}") for i, n in enumerate(names)])
    return counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("failures")) for i, n in enumerate(names)])
        )
    )


def check_not_null(df: DataFrame, *columns: str, table: str = "") -> DataFrame:
    prefix = f"{table}." if table else ""
    return scan_checks(df, {f"not_null {prefix}{c}": F.col(c).isNull() for c in columns})


def check_unique(df: DataFrame, column: str, table: str = "") -> DataFrame:
    """Number of values that occur more than once; nulls are no value."""
    name = f"unique {table}.{column}" if table else f"unique {column}"
    copies = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("copies"))
    return copies.agg(_count_where(F.col("copies") > 1).alias("failures")).select(F.lit(name).alias("check"), "failures")


def orphaned_purchases(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Purchases of no known customer."""
    return sliced_join(facts, customers.select("customer_id"), "customer_id", "left_anti", deal_by=["order_id"])


def orphan_count(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """How many purchases have no known customer; counted per customer before the join."""
    per_customer = facts.groupBy("customer_id").agg(F.count("*").alias("purchases"))
    orphans = per_customer.join(customers.select("customer_id").distinct(), "customer_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("purchases"), F.lit(0)).alias("orphaned_purchases"))


def revenue_reconciliation(daily: DataFrame, facts: DataFrame) -> DataFrame:
    """Total of the daily summary next to the total of the facts."""
    parts = daily.agg(money_sum(F.col("total_revenue")).alias("summary")).withColumn("fact", F.lit(0.0)).unionByName(
        facts.agg(money_sum(F.col("total_amount")).alias("fact")).withColumn("summary", F.lit(0.0))
    )
    return parts.agg(
        F.round(F.sum("summary"), 2).alias("total_from_summary"),
        F.round(F.sum("fact"), 2).alias("total_from_facts"),
    ).withColumn("matches", F.col("total_from_summary").eqNullSafe(F.col("total_from_facts")))


def _wrong_date_parts() -> Column:
    date = F.col("purchase_date")
    return (
        (F.col("purchase_year") != F.year(date))
        | (F.col("purchase_month") != F.month(date))
        | (F.col("purchase_day") != F.day(date))
    )


def date_consistency(facts: DataFrame) -> DataFrame:
    return facts.agg(_count_where(_wrong_date_parts()).alias("inconsistent_dates"))


def _counted(df: DataFrame) -> DataFrame:
    """Rows of a table.

    A count that the scan has taken over is null where no file has rows, though
    Spark holds that it can't be; a sum with 0 makes it a number again.
    """
    none = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("records"))
    return df.agg(F.count("*").alias("records")).unionByName(none).agg(F.sum("records").alias("records"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([_counted(df).select(F.lit(name).alias("table"), "records") for name, df in tables.items()])


def schema_conformance(tables: dict[str, DataFrame], expected: dict[str, list[str]] | None = None) -> DataFrame:
    """Per table: the columns it lacks or has beyond the expected ones, from its header; no row is read."""
    expected = expected or SILVER_COLUMNS

    def names(found: list[str]) -> Column:
        return F.lit(",".join(found))

    def one(name: str, df: DataFrame) -> DataFrame:
        missing = [c for c in expected[name] if c not in df.columns]
        extra = [c for c in df.columns if c not in expected[name]]
        return df.sparkSession.range(1).select(
            F.lit(name).alias("table"),
            F.lit(not missing and not extra).alias("columns_match"),
            names(missing).alias("missing_columns"),
            names(extra).alias("extra_columns"),
        )

    return union_all([one(name, df) for name, df in tables.items()])


def silver_presence(spark: SparkSession, found: dict[str, DataFrame | None]) -> DataFrame:
    """Per silver table: whether it is there, how many rows it has, and whether that is any."""

    def one(name: str, df: DataFrame | None) -> DataFrame:
        counted = (
            spark.range(1).select(F.lit(0).cast("bigint").alias("records"))
            if df is None
            else _counted(df)
        )
        return counted.select(
            F.lit(name).alias("table"),
            F.lit(df is not None).alias("present"),
            "records",
            (F.col("records") > 0).alias("ok"),
        )

    return union_all([one(name, found.get(name)) for name in ENTITIES])


def file_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes of each file behind a table; ``df`` must come straight from a scan."""
    return (
        df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file", "bytes")
        .agg(F.count("*").alias("records"))
    )


def processing_stats(presence: DataFrame, files: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """One row on the whole silver layer."""
    tables = presence.agg(
        F.count("*").alias("total_tables"),
        _count_where(F.col("present")).alias("valid_tables"),
        F.sum("records").alias("total_records"),
        F.bool_and("ok").alias("is_healthy"),
        F.lit(0).cast("bigint").alias("total_bytes"),
    )
    sizes = files.agg(
        F.lit(0).cast("bigint").alias("total_tables"),
        F.lit(0).cast("bigint").alias("valid_tables"),
        F.lit(0).cast("bigint").alias("total_records"),
        F.lit(True).alias("is_healthy"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )
    return (
        tables.unionByName(sizes)
        .agg(
            F.sum("total_tables").alias("total_tables"),
            F.sum("valid_tables").alias("valid_tables"),
            F.sum("total_records").alias("total_records"),
            F.sum("total_bytes").alias("total_bytes"),
            F.bool_and("is_healthy").alias("is_healthy"),
        )
        .withColumn("as_of", stamp(as_of))
    )


def profile(df: DataFrame, name: str) -> DataFrame:
    """Per column: its type, the table's rows and how many of them fill the column."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(f"f{i}") for i, c in enumerate(df.columns)])
    return counts.select(
        F.lit(name).alias("table"),
        F.col("rows").alias("records"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("position"),
                        F.lit(c).alias("column"),
                        F.lit(dtype).alias("type"),
                        F.col(f"f{i}").alias("filled"),
                    )
                    for i, (c, dtype) in enumerate(df.dtypes)
                ]
            )
        ),
    )


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks over the staging and gold tables, one row each."""
    by_table: dict[str, dict[str, Column]] = {}
    for table, column in NOT_NULL:
        by_table.setdefault(table, {})[f"not_null {table}.{column}"] = F.col(column).isNull()
    by_table["fct_purchases"]["date_consistency"] = _wrong_date_parts()

    facts, dim, daily = tables["fct_purchases"], tables["dim_customers"], tables["daily_sales_summary"]
    found = [scan_checks(tables[table], faults) for table, faults in by_table.items()]
    found += [check_unique(tables[table], column, table) for table, column in UNIQUE]
    found.append(
        orphan_count(facts, dim).select(
            F.lit("orphaned_purchases").alias("check"), F.col("orphaned_purchases").alias("failures")
        )
    )
    found.append(
        revenue_reconciliation(daily, facts).select(
            F.lit("revenue_reconciliation").alias("check"),
            F.when(F.col("matches"), 0).otherwise(1).cast("bigint").alias("failures"),
        )
    )
    return union_all(found).select(
        "check",
        F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.col("failures").alias("observed"),
        F.lit(0).cast("bigint").alias("expected"),
    )


def require_passed(checks: DataFrame) -> None:
    """Raise if any check failed. There is one row per check, so the list is short."""
    failed = [f"{r['check']} ({r['observed']})" for r in checks.where("status = 'FAIL'").collect()]
    if failed:
        raise ChecksFailed("; ".join(sorted(failed)))
