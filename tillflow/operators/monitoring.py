"""Freshness, volume and validity measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.times import stamp
from tillflow.operators.cleaning import NORMALISE, rules


def freshness(df: DataFrame, time: str, as_of: datetime | str | None = None) -> DataFrame:
    """The newest time in the table and how many seconds it lies before ``as_of``."""
    return df.agg(F.max(time).alias("latest")).select(
        "latest",
        F.timestamp_diff("SECOND", F.col("latest"), stamp(as_of)).alias("lag_seconds"),
    )


def volume_daily(df: DataFrame, time: str) -> DataFrame:
    """Rows per day, and growth over the calendar day before.

    Each day's count is passed on to the next day and meets that day's own
    count in a second grouping: the rows are counted once, nothing is joined,
    and no window over all days has to run in one task.
    """
    days = df.groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("records"))
    unknown = F.lit(None).cast("bigint")
    passed_on = F.when(F.col("day").isNotNull(), F.col("records"))
    both = days.select(
        F.inline(
            F.array(
                F.struct("day", "records", unknown.alias("previous")),
                F.struct(F.date_add("day", 1).alias("day"), unknown.alias("records"), passed_on.alias("previous")),
            )
        )
    )
    return (
        both.groupBy("day")
        .agg(F.max("records").alias("records"), F.max("previous").alias("previous"))
        .where(F.col("records").isNotNull())
        .withColumn("growth", F.col("records") - F.col("previous"))
    )


def dq_metrics(entity: str, df: DataFrame) -> DataFrame:
    """Per rule: records that fail it as their first, and its share; completeness per column."""
    clean = NORMALISE[entity](df)
    checks = list(rules(entity).items())
    earlier = F.lit(True)
    firsts = []
    for i, (_, met) in enumerate(checks):
        firsts.append(F.count(F.when(earlier & ~met, 1)).alias(f"r{i}"))
        earlier = earlier & met
    columns = clean.columns
    counts = clean.agg(
        F.count("*").alias("records"), *firsts, *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)]
    )

    def metric(kind: str, name: str, value):
        return F.struct(
            F.lit(kind).alias("metric"), F.lit(name).alias("name"), value.alias("records"),
            F.try_divide(value, F.col("records")).alias("ratio"),
        )

    return counts.select(
        F.inline(
            F.array(
                *[metric("failed_rule", name, F.col(f"r{i}")) for i, (name, _) in enumerate(checks)],
                *[metric("filled", name, F.col(f"c{i}")) for i, name in enumerate(columns)],
            )
        )
    ).select(F.lit(entity).alias("table"), "metric", "name", "records", "ratio")
