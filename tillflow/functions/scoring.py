"""Segment and engagement rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment names and the weights of event types.
NO_PURCHASES, ONE_TIME, REGULAR, FREQUENT = "No Purchases", "One-time", "Regular", "Frequent"
EVENT_WEIGHTS = {"purchase": 5, "add_to_cart": 3, "click": 2}


def customer_segment(orders: Column) -> Column:
    """Segment by lifetime order count; null means the customer never bought."""
    return (
        F.when(orders.isNull(), NO_PURCHASES)
        .when(orders == 1, ONE_TIME)
        .when(orders.between(2, 5), REGULAR)
        .when(orders > 5, FREQUENT)
    )


def engagement_score(event_type: Column, event_count: Column) -> Column:
    """Event count weighted by type; types are matched in lower case, as streamed."""
    weight = F.lit(1)
    for name, factor in EVENT_WEIGHTS.items():
        weight = F.when(event_type == name, factor).otherwise(weight)
    return event_count * weight
