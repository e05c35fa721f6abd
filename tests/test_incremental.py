"""Daily summary kept up to date, and distinct counts that roll up."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tillflow.operators import analytics, gold, sketches
from tillflow.plans import incremental

RUN = "2026-01-01 00:00:00"
PURCHASES = (
    "order_id string, customer_id string, product_id int, purchase_timestamp timestamp, purchase_date date, purchase_year int, "
    "purchase_month int, purchase_day int, quantity int, unit_price double, total_amount double, loaded_at timestamp"
)


def purchase(i, customer, product, day, quantity=1, price=1.25):
    d = date(2024, 1, 1) + timedelta(days=day)
    total = None if quantity is None or price is None else round(quantity * price, 2)
    return (f"o{i}", customer, product, datetime(d.year, d.month, d.day), d, d.year, d.month, d.day, quantity, price, total, None)


def frame(spark, rows):
    return spark.createDataFrame(rows, PURCHASES)


def people(spark, ids):
    return spark.createDataFrame([(i, f"n{i}", f"{i}@x.com", "x.com", "FR", None, None) for i in ids], "customer_id string, name string, email_clean string, email_domain string, country string, signup_date timestamp, loaded_at timestamp")


def whole(spark, rows, ids):
    purchases, customers = frame(spark, rows), people(spark, ids)
    return gold.daily_sales_summary(gold.fct_purchases(purchases, gold.dim_customers(customers, purchases)), RUN)


def same(spark, root, rows, ids):
    want = whole(spark, rows, ids)
    got = incremental.read_summary(spark, root, want)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def days(df):
    return sorted((r["purchase_date"] - date(2024, 1, 1)).days for r in df.collect())


def test_a_delivery_touches_its_days_and_those_of_changed_segments(spark, folder):
    first = [purchase(1, "a", 5, 0), purchase(2, "b", 5, 1), purchase(3, "b", 40_000, 1), purchase(4, "ghost", -7, 2), purchase(5, None, None, 3, None, None)]
    assert days(incremental.delivered(spark, folder, 1, frame(spark, first), people(spark, "ab"), RUN)) == [0, 1, 2, 3]
    same(spark, folder, first, "ab")
    # a's second order makes a new customer of day 0 a returning one; b stays what b is, so day 1 is left alone
    second = [purchase(6, "a", 6, 9), purchase(7, "b", 6, 9)]
    assert days(incremental.delivered(spark, folder, 2, frame(spark, second), people(spark, "ab"), RUN)) == [0, 9]
    same(spark, folder, first + second, "ab")
    # a customer becomes known, with no purchase at all in the delivery
    assert days(incremental.delivered(spark, folder, 3, frame(spark, []), people(spark, ["a", "b", "ghost"]), RUN)) == [2]
    same(spark, folder, first + second, ["a", "b", "ghost"])
    # a delivery that runs again changes nothing
    assert days(incremental.delivered(spark, folder, 3, frame(spark, []), people(spark, ["a", "b", "ghost"]), RUN)) == [2]
    same(spark, folder, first + second, ["a", "b", "ghost"])


def test_a_delivery_of_nothing(spark, folder):
    incremental.delivered(spark, folder, 1, frame(spark, [purchase(1, "a", 1, 0)]), people(spark, "a"), RUN)
    assert days(incremental.delivered(spark, folder, 2, frame(spark, []), people(spark, "a"), RUN)) == []
    same(spark, folder, [purchase(1, "a", 1, 0)], "a")


def test_many_deliveries(spark, folder):
    draw, rows = random.Random(8), []
    for number in range(1, 5):
        new = [
            purchase(1000 * number + i, draw.choice(["a", "b", "c", "d", "e", "f", None]), draw.choice([1, 2, 32_768, 32_769, 99_999, None]), draw.randrange(6 * number), draw.choice([1, 2, None]), draw.choice([0.1, 19.99, 1 / 3]))
            for i in range(12)
        ]
        rows += new
        ids = "abcdef"[: number + 2]
        incremental.delivered(spark, folder, number, frame(spark, new), people(spark, ids), RUN)
        want = {r["purchase_date"]: r for r in whole(spark, rows, ids).collect()}
        got = {r["purchase_date"]: r for r in incremental.read_summary(spark, folder, whole(spark, rows, ids)).collect()}
        assert got.keys() == want.keys()
        for day, row in want.items():
            for name in row.asDict():
                a, b = got[day][name], row[name]
                assert a == b or abs(a - b) < 1e-9, (day, name, a, b)


def test_sketches_roll_up(spark):
    start = datetime(2024, 3, 1, 23, 50)
    rows = [(start + timedelta(seconds=20 * i), f"u{i % 7}", f"s{i % 11}", "p", "click") for i in range(300)] + [(None, "u", "s", "p", "click"), (start, None, "s0", "p", "click")]
    events = spark.createDataFrame(rows, "timestamp timestamp, user_id string, session_id string, page_url string, event_type string")
    stored = analytics.flatten_window(sketches.click_sketches(events))
    for grain, starts in (("minute", 100), ("hour", 3), ("day", 2)):
        got = {r["start"]: r for r in sketches.rolled_up(stored, grain).collect()}
        assert len(got) == starts
        exact = events.where("timestamp is not null").groupBy(F.date_trunc(grain, "timestamp").alias("start")).agg(
            F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.countDistinct("session_id").alias("sessions"))
        for r in exact.collect():
            # small counts are exact
            assert (got[r["start"]]["event_count"], got[r["start"]]["unique_users"], got[r["start"]]["unique_sessions"]) == (r["n"], r["users"], r["sessions"])


def test_sketches_of_many_values_are_close(spark):
    events = spark.range(60_000).select(
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 3600)).alias("timestamp"), (F.col("id") % 20_000).cast("string").alias("user_id"),
        F.col("id").cast("string").alias("session_id"), F.lit("p").alias("page_url"), F.lit("view").alias("event_type"))
    got = sketches.rolled_up(analytics.flatten_window(sketches.click_sketches(events)), "day").collect()
    users, sessions = sum(r["unique_users"] for r in got), sum(r["unique_sessions"] for r in got)
    assert len(got) == 1 and abs(users - 20_000) < 1_000 and abs(sessions - 60_000) < 3_000
