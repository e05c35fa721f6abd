"""Distinct counts that can be rolled up: a sketch of users and one of sessions per minute, page and event type.

Counts of minutes don't add up to those of an hour, sketches do: the union of
two sketches is the sketch of both minutes' events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.operators.analytics import LATENESS, WINDOW

#: Registers of a sketch are 2 ** PRECISION; the error of an estimate is about 1.04 / sqrt(2 ** PRECISION), 1.6 %.
PRECISION = 12
GRAINS = ("minute", "hour", "day")


def click_sketches(events: DataFrame) -> DataFrame:
    """Events per minute, page and event type, with sketches of users and sessions; for batches and streams."""
    minute = F.window("timestamp", WINDOW).alias("window")
    return (
        events.withWatermark("timestamp", LATENESS)
        .groupBy(minute, "page_url", "event_type")
        .agg(
            F.count("*").alias("event_count"),
            F.hll_sketch_agg("user_id", F.lit(PRECISION)).alias("users"),
            F.hll_sketch_agg("session_id", F.lit(PRECISION)).alias("sessions"),
        )
    )


def rolled_up(sketches: DataFrame, grain: str) -> DataFrame:
    """Stored sketches (``window_start``) as events and estimated distinct users and sessions per minute, hour or day."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    estimate = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    return sketches.groupBy(F.date_trunc(grain, "window_start").alias("start"), "page_url", "event_type").agg(
        F.sum("event_count").alias("event_count"), estimate("users").alias("unique_users"), estimate("sessions").alias("unique_sessions")
    )
