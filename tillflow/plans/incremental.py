"""The daily summary kept up to date: a delivery changes the days it touches and no others.

A store holds, in one folder per delivery,

    customer_days   a row per day and customer: orders, quantity, amounts
    product_days    per day a bitmap of products
    customers       orders per customer, and the customers that became known
    summary         the days that were computed again

A delivery touches the days of its purchases, and the days of customers whose
segment it changes: a second order makes a new customer a returning one on all
the days they bought.  For these days the rows of all deliveries are added up;
files lie in the order of days, so others are skipped.  ``read_summary`` takes
each day's newest row.  A delivery that runs again replaces its own folders, so
it may be repeated after a failure, and a reader sees a day before or after a
delivery, never in between.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillflow.functions.money import cents_total, whole_cents
from tillflow.functions.scoring import FREQUENT, ONE_TIME, REGULAR, customer_segment
from tillflow.functions.times import stamp
from tillflow.operators.gold import DAY
from tillflow.operators.keyed import upsert
from tillflow.sinks import folders
from tillflow.sinks.tables import write_table

_DAY = "purchase_date date, purchase_year int, purchase_month int, purchase_day int"
DAYS = f"{_DAY}, customer_id string, orders bigint, quantity bigint, cents bigint, cent_rows bigint, amount double, amount_rows bigint, delivery int"
PRODUCTS = f"{_DAY}, bucket bigint, products binary, delivery int"
CUSTOMERS = "customer_id string, orders bigint, known boolean, delivery int"


def customer_days(purchases: DataFrame) -> DataFrame:
    """Purchases per day and customer, as sums that add up over deliveries."""
    amount, cents = F.col("total_amount"), whole_cents(F.col("total_amount"))
    return purchases.groupBy(*DAY, "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.try_sum(cents).alias("cents"),
        F.coalesce(F.when(F.try_sum(cents).isNotNull(), F.count(cents)), F.lit(0)).alias("cent_rows"),
        F.sum(amount).alias("amount"),
        F.count(amount).alias("amount_rows"),
    )


def product_days(purchases: DataFrame) -> DataFrame:
    """Per day and range of product numbers a bitmap of the products bought: 4 KB for 32,768 numbers."""
    number = F.col("product_id")
    return (
        purchases.where(number.isNotNull()).groupBy(*DAY, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("products"))
    )


def delivered(spark: SparkSession, root: str, delivery: int, purchases: DataFrame, customers: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Adds a delivery of staged purchases; ``customers`` are all staged customers known by now, one row each.

    Deliveries are numbered upwards from 1.  Returns the days that were
    computed again.  The summary is that of ``gold.daily_sales_summary`` over
    all deliveries so far.
    """
    earlier = _read(spark, root, "customers", CUSTOMERS)
    earlier = earlier.where(F.col("delivery") < delivery)
    before = earlier.groupBy("customer_id").agg(F.sum("orders").alias("orders"), F.bool_or("known").alias("known"))
    known = customers.select("customer_id").distinct().withColumn("known", F.lit(True))
    added = purchases.groupBy("customer_id").agg(F.count("*").alias("orders"))
    newly = known.join(before.where("known").select("customer_id"), "customer_id", "left_anti")
    changes = added.withColumn("known", F.lit(False)).unionByName(newly.withColumn("orders", F.lit(0).cast("bigint")))
    write_table(changes.groupBy("customer_id").agg(F.sum("orders").alias("orders"), F.bool_or("known").alias("known")), f"{root}/customers/delivery={delivery}")
    for store, rows in (("customer_days", customer_days(purchases)), ("product_days", product_days(purchases))):
        by_day = rows.repartitionByRange("purchase_date").sortWithinPartitions("purchase_date")
        write_table(by_day, f"{root}/{store}/delivery={delivery}")

    # days of this delivery, and of customers whose segment it has changed
    days = _read(spark, root, "customer_days", DAYS).where(F.col("delivery") <= delivery)
    state = _read(spark, root, "customers", CUSTOMERS).where(F.col("delivery") <= delivery)
    now = state.groupBy("customer_id").agg(
        F.sum("orders").alias("orders"), F.bool_or("known").alias("known"),
        F.sum(F.when(F.col("delivery") < delivery, F.col("orders"))).alias("orders_before"),
        F.bool_or(F.when(F.col("delivery") < delivery, F.col("known"))).alias("known_before"),
    )
    segment = lambda known, orders: F.when(F.col(known) & (F.col(orders) > 0), customer_segment(F.col(orders)))
    segments = now.select("customer_id", segment("known", "orders").alias("segment"), segment("known_before", "orders_before").alias("segment_before"))
    changed = segments.where(~F.col("segment").eqNullSafe(F.col("segment_before"))).select("customer_id")
    touched = days.where(F.col("delivery") == delivery).select("purchase_date").unionByName(
        days.where(F.col("delivery") < delivery).join(changed, "customer_id", "left_semi").select("purchase_date")
    )
    touched = [r["purchase_date"] for r in touched.distinct().collect()]  # days, of which a table has thousands
    again = F.col("purchase_date").isin(touched)
    if touched:  # the scan skips row groups by the first and last of the days
        again &= F.col("purchase_date").between(min(touched), max(touched))
    products = _read(spark, root, "product_days", PRODUCTS).where(F.col("delivery") <= delivery)
    summary = summarised(days.where(again), products.where(again), segments).withColumn("loaded_at", stamp(run_ts))
    write_table(summary, f"{root}/summary/delivery={delivery}")
    return spark.createDataFrame([(d,) for d in touched], "purchase_date date")


def summarised(days: DataFrame, products: DataFrame, segments: DataFrame) -> DataFrame:
    """The measures of days, from sums per day and customer, bitmaps of products and the customers' segments."""
    sums = days.groupBy(*DAY, "customer_id").agg(
        *[F.sum(c).alias(c) for c in ("orders", "quantity", "cent_rows", "amount", "amount_rows")], F.try_sum("cents").alias("cents")
    )
    rated = sums.join(segments.select("customer_id", "segment"), "customer_id", "left")
    revenue = cents_total(F.col("cents"), F.col("amount"), F.sum("cent_rows"), F.sum("amount_rows"))
    per_day = rated.groupBy(*DAY).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("quantity").alias("total_quantity"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.sum("amount_rows")).alias("avg_order_value"),
        F.count(F.when(F.col("segment") == ONE_TIME, F.col("customer_id"))).alias("new_customers"),
        F.count(F.when(F.col("segment").isin(REGULAR, FREQUENT), F.col("customer_id"))).alias("returning_customers"),
    )
    maps = products.groupBy(*DAY, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("products")).alias("n"))
    counts = maps.groupBy(*DAY).agg(F.sum("n").alias("unique_products"))
    same = [per_day[c].eqNullSafe(counts[c]) for c in DAY]
    return per_day.join(counts, same, "left").select(
        *[per_day[c] for c in DAY], "total_orders", "unique_customers", F.coalesce("unique_products", F.lit(0)).alias("unique_products"),
        "total_quantity", "total_revenue", "avg_order_value", "new_customers", "returning_customers",
    )


def read_summary(spark: SparkSession, root: str, like: DataFrame) -> DataFrame:
    """The summary, with the columns of ``like`` in order: each day as of the last delivery that touched it."""
    schema = StructType([*like.schema.fields]).add("delivery", "integer")
    return upsert(spark.read.schema(schema).parquet(f"{root}/summary"), ["purchase_date"], ["delivery"]).select(like.columns)


def _read(spark: SparkSession, root: str, store: str, schema: str) -> DataFrame:
    if not folders.exists(spark, f"{root}/{store}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{store}")
