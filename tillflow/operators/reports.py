"""Top-k, trend and lookup reports over gold and silver tables.

Every limit here is the report itself.  Sorts end in a key, so equal values
always come out in the same order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_days(daily: DataFrame, k: int = 5) -> DataFrame:
    return (
        daily.orderBy(F.desc("total_revenue"), "purchase_date")
        .limit(k)
        .select("purchase_date", "total_orders", "unique_customers", "total_revenue", "avg_order_value")
    )


def top_customers(dim: DataFrame, k: int = 5) -> DataFrame:
    return (
        dim.where(F.col("total_spent") > 0)
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(k)
        .select("name", "email", "country", "total_orders", "total_spent", "customer_segment")
    )


def recent_purchases(facts: DataFrame, k: int = 5) -> DataFrame:
    return (
        facts.orderBy(
            F.desc("purchase_date"), F.desc("purchase_timestamp"),
            "order_id", "product_id", "quantity", "total_amount", "name", "country",
        )
        .limit(k)
        .select("purchase_date", "name", "country", "product_id", "quantity", "total_amount")
    )


def daily_sales_trend(daily: DataFrame) -> DataFrame:
    return daily.select(
        "purchase_date", "total_orders", "unique_customers",
        F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
    ).orderBy(F.desc("purchase_date"))


def segment_distribution(dim: DataFrame) -> DataFrame:
    return dim.groupBy("customer_segment").agg(F.count("*").alias("customers"))


def product_performance(facts: DataFrame) -> DataFrame:
    from tillflow.functions.money import money_sum

    return facts.groupBy("product_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(F.col("total_amount")).alias("total_revenue"),
    )


def lookup(df: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values.

    Plain comparisons, so they reach the Parquet scan and prune partitions of a
    table stored by those columns.
    """
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
