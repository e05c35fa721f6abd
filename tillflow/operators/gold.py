"""Gold models: customer dimension, purchase facts, daily summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import cents_total, money_avg, money_sum, whole_cents
from tillflow.functions.scoring import FREQUENT, ONE_TIME, REGULAR, customer_segment
from tillflow.functions.times import stamp
from tillflow.operators.skew import sliced_join

DAY = ["purchase_date", "purchase_year", "purchase_month", "purchase_day"]


def customer_rollup(purchases: DataFrame) -> DataFrame:
    amount = F.col("total_amount")
    return purchases.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        money_sum(amount).alias("total_spent"),
        money_avg(amount).alias("avg_order_value"),
        F.min("purchase_date").alias("first_purchase_date"),
        F.max("purchase_date").alias("last_purchase_date"),
    )


def dim_customers(customers: DataFrame, purchases: DataFrame) -> DataFrame:
    """Every customer with what they bought; zeros for those who never did."""
    wanted = customers.select(
        "customer_id", "name", F.col("email_clean").alias("email"), "email_domain", "country",
        "signup_date", "loaded_at",
    )
    # One row per customer comes out of the rollup, so only the left can hold a hot key.
    joined = sliced_join(wanted, customer_rollup(purchases), "customer_id", deal_by=["email"], right_unique=True)
    return joined.select(
        "customer_id", "name", "email", "email_domain", "country", "signup_date",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "first_purchase_date", "last_purchase_date",
        customer_segment(F.col("total_orders")).alias("customer_segment"),
        "loaded_at",
    )


def fct_purchases(purchases: DataFrame, customers: DataFrame) -> DataFrame:
    """Every purchase with its customer's attributes, null for an unknown customer.

    A customer with very many purchases is dealt over several tasks.  Adaptive execution alone would not
    split such a partition where the facts are grouped by customer next, nor where it is small as compressed.
    """
    facts = purchases.select(
        "order_id", "customer_id", "product_id", "purchase_timestamp", *DAY,
        "quantity", "unit_price", "total_amount", "loaded_at",
    )
    attributes = customers.select("customer_id", "name", "email", "country", "customer_segment")
    joined = sliced_join(facts, attributes, "customer_id", deal_by=["order_id", "product_id"], right_unique=True, merged=False)
    return joined.select(
        "order_id", "customer_id", "product_id", "purchase_timestamp", *DAY,
        "quantity", "unit_price", "total_amount",
        "name", "email", "country", "customer_segment", "loaded_at",
    )


def daily_sales_summary(facts: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    """Orders, revenue and distinct buyers and products per day.

    Purchases are grouped by day and customer, and apart from that by day and
    product, before anything is counted per day.  That shrinks a day's rows
    ahead of the shuffle and spreads a busy day over all its customers.  Four
    distinct counts in one aggregate would copy each purchase five times.
    """
    amount = F.col("total_amount")
    cents = whole_cents(amount)
    per_customer = facts.groupBy(*DAY, "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("quantity"),
        F.try_sum(cents).alias("cents"),
        # A sum beyond the integer range counts no rows, so the day falls back to doubles.
        F.coalesce(F.when(F.try_sum(cents).isNotNull(), F.count(cents)), F.lit(0)).alias("cent_rows"),
        F.sum(amount).alias("amount"),
        F.count(amount).alias("amount_rows"),
        F.bool_or(F.col("customer_segment") == ONE_TIME).alias("one_time"),
        F.bool_or(F.col("customer_segment").isin(REGULAR, FREQUENT)).alias("returning"),
    )
    revenue = cents_total(F.col("cents"), F.col("amount"), F.sum("cent_rows"), F.sum("amount_rows"))
    customers = per_customer.groupBy(*DAY).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("quantity").alias("total_quantity"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue, F.sum("amount_rows")).alias("avg_order_value"),
        F.count(F.when(F.col("one_time"), F.col("customer_id"))).alias("new_customers"),
        F.count(F.when(F.col("returning"), F.col("customer_id"))).alias("returning_customers"),
    )
    products = (
        facts.select(*DAY, "product_id").distinct().groupBy(*DAY).agg(F.count("product_id").alias("unique_products"))
    )
    # One row per day on each side: a union and a grouping join them, null days too.
    both = customers.unionByName(products, allowMissingColumns=True)
    measures = [
        "total_orders", "unique_customers", "unique_products", "total_quantity", "total_revenue",
        "avg_order_value", "new_customers", "returning_customers",
    ]
    return (
        both.groupBy(*DAY).agg(*[F.max(m).alias(m) for m in measures]).withColumn("loaded_at", stamp(run_ts))
    )
