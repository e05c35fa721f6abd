"""Staging models: silver columns under their gold names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.times import stamp


# Columns of the three models, in order.


def stg_customers(silver: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    return silver.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "name", "email", "country", "signup_date", "processed_timestamp",
        "signup_year", "signup_month", "signup_day", "email_domain", "data_source",
        F.lower("email").alias("email_clean"),
        stamp(run_ts).alias("loaded_at"),
    )


def stg_purchases(silver: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    return silver.where(F.col("order_id").isNotNull()).select(
        "order_id",
        F.col("user_id").alias("customer_id"),
        F.col("timestamp").alias("purchase_timestamp"),
        "product_id", "quantity", "unit_price", "total_amount", "processed_timestamp",
        F.to_date("purchase_date").alias("purchase_date"),
        "purchase_hour", "purchase_year", "purchase_month", "purchase_day", "data_source",
        stamp(run_ts).alias("loaded_at"),
    )


def stg_clickstream(silver: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    return silver.where(F.col("user_id").isNotNull()).select(
        "user_id",
        F.col("timestamp").alias("event_timestamp"),
        "page_url", "event_type", "product_id", "session_id", "processed_timestamp",
        F.to_date("event_date").alias("event_date"),
        "event_hour", "event_year", "event_month", "event_day", "data_source",
        stamp(run_ts).alias("loaded_at"),
    )


STAGING = {"clickstream": stg_clickstream, "purchases": stg_purchases, "customers": stg_customers}


def register_staging(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Name the staging models ``stg_<entity>`` for SQL users; they stay lazy."""
    for entity, df in tables.items():
        df.createOrReplaceTempView(f"stg_{entity}")
