"""One schema per entity and layer.

``WIRE`` is what a CSV line or JSON message holds: times are still text.
``BRONZE`` is the decoded record.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

ENTITIES = ("clickstream", "purchases", "customers")

# The field that holds each entity's time.
TIME_FIELD = {"clickstream": "timestamp", "purchases": "timestamp", "customers": "signup_date"}

# Primary keys of the keyed copies.
KEYS = {
    "clickstream": ["user_id", "timestamp"],
    "purchases": ["order_id"],
    "customers": ["customer_id"],
}


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


TEXT, INT, DOUBLE, TIME = StringType(), IntegerType(), DoubleType(), TimestampType()

# Record layouts.
BRONZE = {
    "clickstream": _struct(
        user_id=TEXT, timestamp=TIME, page_url=TEXT, event_type=TEXT, product_id=INT, session_id=TEXT
    ),
    "purchases": _struct(
        order_id=TEXT, user_id=TEXT, timestamp=TIME, product_id=INT, quantity=INT, price=DOUBLE
    ),
    "customers": _struct(customer_id=TEXT, name=TEXT, email=TEXT, country=TEXT, signup_date=TIME),
}

WIRE = {
    entity: StructType(
        [StructField(f.name, TEXT if f.dataType == TIME else f.dataType, True) for f in schema]
    )
    for entity, schema in BRONZE.items()
}

# Silver column order, which the conformance check compares.
SILVER_COLUMNS = {
    "clickstream": [
        "user_id", "timestamp", "page_url", "event_type", "product_id", "session_id",
        "processed_timestamp", "event_date", "event_hour", "event_year", "event_month",
        "event_day", "data_source",
    ],
    "purchases": [
        "order_id", "user_id", "timestamp", "product_id", "quantity", "unit_price",
        "total_amount", "processed_timestamp", "purchase_date", "purchase_hour",
        "purchase_year", "purchase_month", "purchase_day", "data_source",
    ],
    "customers": [
        "customer_id", "name", "email", "country", "signup_date", "processed_timestamp",
        "signup_year", "signup_month", "signup_day", "email_domain", "data_source",
    ],
}

_SILVER_TYPES = {
    "timestamp": TIME, "signup_date": TIME, "processed_timestamp": TIME,
    "unit_price": DOUBLE, "total_amount": DOUBLE, "product_id": INT, "quantity": INT,
}


def silver_schema(entity: str) -> StructType:
    def dtype(name: str):
        if name.endswith(("_hour", "_year", "_month", "_day")):
            return INT
        return _SILVER_TYPES.get(name, TEXT)

    return StructType([StructField(name, dtype(name), True) for name in SILVER_COLUMNS[entity]])
