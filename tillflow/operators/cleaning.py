"""Silver rules: normalise a raw record, then keep it or set it aside.

Each entity is a set of normalised columns and an ordered list of named rules.
A rule is a condition a good record meets and is never null, so a record fails
or passes it.  The silver table is the records meeting all rules; the
quarantine is the rest, with the first rule each one failed.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import line_total, rounded
from tillflow.functions.times import day_parts, day_text, parsed_time, stamp
from tillflow.schemas import SILVER_COLUMNS

# The accepted email pattern and the lineage label of batch loads.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,6}$"
BATCH_SOURCE = "batch_csv"


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def _known_bad(condition: Column) -> Column:
    """False only where the condition is known to hold; an unknown is let through."""
    return ~F.coalesce(condition, F.lit(False))


def normalised_clickstream(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        F.trim("user_id").alias("user_id"),
        parsed_time(df, "timestamp").alias("timestamp"),
        F.trim("page_url").alias("page_url"),
        F.upper(F.trim("event_type")).alias("event_type"),
        "product_id",
        F.trim("session_id").alias("session_id"),
        *others,
    )


def normalised_purchases(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        F.trim("order_id").alias("order_id"),
        F.trim("user_id").alias("user_id"),
        parsed_time(df, "timestamp").alias("timestamp"),
        "product_id",
        "quantity",
        "price",
        *others,
    )


def normalised_customers(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        F.trim("customer_id").alias("customer_id"),
        F.trim("name").alias("name"),
        F.lower(F.trim("email")).alias("email"),
        F.upper(F.trim("country")).alias("country"),
        parsed_time(df, "signup_date").alias("signup_date"),
        *others,
    )


NORMALISE = {
    "clickstream": normalised_clickstream,
    "purchases": normalised_purchases,
    "customers": normalised_customers,
}


def rules(entity: str) -> dict[str, Column]:
    """Named conditions a normalised record has to meet, in order of report."""
    if entity == "clickstream":
        return {
            "user_id missing": _filled("user_id"),
            "timestamp missing": F.col("timestamp").isNotNull(),
            "event_type missing": _filled("event_type"),
        }
    if entity == "purchases":
        # An unknown quantity or price is no reason to reject a purchase.
        return {
            "order_id missing": _filled("order_id"),
            "user_id missing": _filled("user_id"),
            "timestamp missing": F.col("timestamp").isNotNull(),
            "quantity not positive": _known_bad(F.col("quantity") <= 0),
            "price negative": _known_bad(F.col("price") < 0),
        }
    return {
        "customer_id missing": _filled("customer_id"),
        "name missing": _filled("name"),
        "email missing": _filled("email"),
        "email malformed": _known_bad(~F.col("email").rlike(EMAIL_PATTERN)),
    }


def _derived(entity: str) -> dict[str, Column]:
    if entity == "clickstream":
        time = F.col("timestamp")
        return {"event_date": day_text(time), "event_hour": F.hour(time), **day_parts(time, "event")}
    if entity == "purchases":
        time = F.col("timestamp")
        return {
            "unit_price": rounded(F.col("price")),
            "total_amount": line_total(F.col("quantity"), F.col("price")),
            "purchase_date": day_text(time),
            "purchase_hour": F.hour(time),
            **day_parts(time, "purchase"),
        }
    return {
        **day_parts(F.col("signup_date"), "signup"),
        "email_domain": F.substring_index("email", "@", -1),
    }


def with_lineage(df: DataFrame, source: str, run_ts: datetime | str | None) -> DataFrame:
    return df.withColumns({"processed_timestamp": stamp(run_ts), "data_source": F.lit(source)})


def silver(
    entity: str, df: DataFrame, run_ts: datetime | str | None = None, source: str = BATCH_SOURCE
) -> DataFrame:
    """The records that meet every rule, with the silver columns in order."""
    good = reduce(Column.__and__, rules(entity).values())
    kept = NORMALISE[entity](df).where(good).withColumns(_derived(entity))
    return with_lineage(kept, source, run_ts).select(*SILVER_COLUMNS[entity])


def _first_failed(entity: str) -> Column:
    """The first rule that a normalised record fails; null where it meets them all."""
    return reduce(
        lambda chain, rule: F.coalesce(chain, F.when(~rule[1], rule[0])),
        rules(entity).items(),
        F.lit(None).cast("string"),
    )


def quarantine(entity: str, df: DataFrame) -> DataFrame:
    """The records that fail a rule, normalised, with the first rule failed."""
    return NORMALISE[entity](df).withColumn("failed_rule", _first_failed(entity)).where("failed_rule IS NOT NULL")


def message_quarantine(entity: str, decoded: DataFrame) -> DataFrame:
    """Of checked messages (``raw``, ``fault``) those that can't be read or fail a rule, normalised, with the reason.

    A message's own fault comes before the rules, which what is left of it may
    also fail.  Serves batches and streams.
    """
    normal = NORMALISE[entity](decoded, "raw", "fault")
    reason = F.coalesce(F.col("fault"), _first_failed(entity))
    return normal.withColumn("failed_rule", reason).drop("fault").where("failed_rule IS NOT NULL")


def stream_filter(entity: str, df: DataFrame) -> DataFrame:
    """The one rule per entity that live records pass on their way to silver."""
    return df.where(
        {
            "clickstream": F.col("event_type").isNotNull(),
            "purchases": F.col("quantity") > 0,
            "customers": F.col("email").isNotNull(),
        }[entity]
    )
