"""Windowed measures over live feeds; the same functions serve batch and stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import cents_total, revenue_sum, whole_cents
from tillflow.functions.scoring import engagement_score
from tillflow.functions.times import day_text, stamp

# Window length and how long late events are waited for.
WINDOW, LATENESS = "1 minute", "1 minute"


def _timed(df: DataFrame) -> DataFrame:
    return df.withWatermark("timestamp", LATENESS)


def clickstream_analytics(
    events: DataFrame, run_ts: datetime | str | None = None, distinct: str = "exact"
) -> DataFrame:
    """Events, distinct users and distinct sessions per minute, page and event type.

    A stream accepts no distinct count.  ``exact`` counts each event once under
    its user and once under its session, grouped first by that value and then
    by window: state is one small row per value, never a set that grows inside
    one row.  ``approx`` keeps a fixed-size sketch per window instead.
    """
    if distinct == "approx":
        counted = _timed(events).groupBy(F.window("timestamp", WINDOW).alias("window"), "page_url", "event_type").agg(
            F.count("*").alias("event_count"),
            F.approx_count_distinct("user_id").alias("unique_users"),
            F.approx_count_distinct("session_id").alias("unique_sessions"),
        )
    elif distinct == "exact":
        marks = _timed(events).select(
            "timestamp", "page_url", "event_type",
            F.explode(
                F.array(
                    F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("value")),
                    F.struct(F.lit("session").alias("kind"), F.col("session_id").alias("value")),
                )
            ).alias("mark"),
        )
        per_value = marks.groupBy(
            F.window("timestamp", WINDOW).alias("window"), "page_url", "event_type", "mark.kind", "mark.value"
        ).agg(F.count("*").alias("events"))
        user = F.col("kind") == "user"
        counted = per_value.groupBy("window", "page_url", "event_type").agg(
            F.sum(F.when(user, F.col("events"))).alias("event_count"),
            F.count(F.when(user, F.col("value"))).alias("unique_users"),
            F.count(F.when(~user, F.col("value"))).alias("unique_sessions"),
        )
    else:
        raise ValueError(f"distinct must be 'exact' or 'approx', not {distinct!r}")
    # Every event of a one-minute window lies in one hour of one day.
    return counted.withColumns(
        {
            "hour_of_day": F.hour("window.start"),
            "day_of_week": F.dayofweek("window.start"),
            "processing_time": stamp(run_ts),
            "engagement_score": engagement_score(F.col("event_type"), F.col("event_count")),
        }
    )


def purchase_analytics(purchases: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Orders, quantity, revenue and average price per minute and product."""
    price = F.col("price")
    cents = whole_cents(price)
    average = F.try_divide(cents_total(cents, price, F.count(cents), F.count(price)), F.count(price))
    return (
        _timed(purchases)
        .groupBy(F.window("timestamp", WINDOW).alias("window"), "product_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("quantity").alias("total_quantity"),
            F.round(revenue_sum(F.col("quantity"), price), 2).alias("total_revenue"),
            F.round(average, 2).alias("avg_price"),
        )
        .withColumn("processing_time", stamp(run_ts))
    )


def customer_analytics(customers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Customers per country at the time of the run."""
    return (
        customers.groupBy("country")
        .agg(F.count("customer_id").alias("customer_count"))
        .withColumns({"snapshot_date": day_text(stamp(run_ts)), "processing_time": stamp(run_ts)})
    )


def flatten_window(df: DataFrame) -> DataFrame:
    """The window as two plain columns, which every file format can hold."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )
