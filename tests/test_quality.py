from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillflow.operators import quality
from tillflow.operators.monitoring import freshness, volume_daily
from tillflow.plans import jobs

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def tables(spark):
    customers = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    facts = spark.createDataFrame(
        [("o1", "c1", DAY, 2024, 1, 1, 1.5), ("o2", "c2", DAY, 2024, 1, 1, 2.5)],
        "order_id string, customer_id string, purchase_date date, purchase_year int, purchase_month int, purchase_day int, total_amount double",
    )
    daily = spark.createDataFrame([(DAY, 4.0)], "purchase_date date, total_revenue double")
    return {
        "stg_customers": customers, "dim_customers": customers, "stg_purchases": facts.select("order_id", "customer_id"),
        "fct_purchases": facts, "daily_sales_summary": daily,
    }


def failed(checks):
    return {r["check"]: r["observed"] for r in checks.where("status = 'FAIL'").collect()}


def test_sound_tables_pass(tables):
    checks = jobs.run_checks(tables, stop_on_failure=True)
    assert checks.count() == 7 + 5 + 3
    assert failed(checks) == {}


@pytest.mark.parametrize(
    ("table", "change", "fault"),
    [
        ("fct_purchases", {"order_id": "CASE WHEN order_id = 'o1' THEN NULL ELSE order_id END"}, "not_null fct_purchases.order_id"),
        ("fct_purchases", {"order_id": "'o1'"}, "unique fct_purchases.order_id"),
        ("dim_customers", {"customer_id": "'c1'"}, "unique dim_customers.customer_id"),
        ("fct_purchases", {"purchase_year": "2023"}, "date_consistency"),
        ("fct_purchases", {"customer_id": "'nobody'"}, "orphaned_purchases"),
        ("daily_sales_summary", {"total_revenue": "total_revenue + 0.01"}, "revenue_reconciliation"),
        ("daily_sales_summary", {"purchase_date": "CAST(NULL AS DATE)"}, "not_null daily_sales_summary.purchase_date"),
    ],
)
def test_planted_fault_is_found(tables, table, change, fault):
    tables[table] = tables[table].withColumns({c: F.expr(e) for c, e in change.items()})
    checks = quality.run_checks(tables)
    assert fault in failed(checks)
    with pytest.raises(quality.ChecksFailed):
        quality.require_passed(checks)


def test_orphans(tables):
    facts = tables["fct_purchases"].withColumn("customer_id", F.expr("nullif(customer_id, 'c2')"))
    assert [r["order_id"] for r in quality.orphaned_purchases(facts, tables["dim_customers"]).collect()] == ["o2"]
    assert quality.orphan_count(facts, tables["dim_customers"]).collect()[0][0] == 1


def test_schema_conformance(spark):
    df = spark.createDataFrame([(1, 2)], "a int, c int")
    row = quality.schema_conformance({"t": df}, {"t": ["a", "b"]}).collect()[0]
    assert (row["columns_match"], row["missing_columns"], row["extra_columns"]) == (False, "b", "c")


def test_presence_of_missing_table(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = {r["table"]: (r["present"], r["records"], r["ok"]) for r in quality.silver_presence(spark, {"purchases": df, "customers": df.limit(0)}).collect()}
    assert got == {"clickstream": (False, 0, False), "purchases": (True, 1, True), "customers": (True, 0, False)}


def test_file_stats(spark, folder):
    spark.range(0, 100, 1, 4).write.parquet(f"{folder}/t")
    stats = quality.file_stats(spark.read.parquet(f"{folder}/t")).collect()
    assert len(stats) == 4 and sum(r["records"] for r in stats) == 100 and all(r["bytes"] > 0 for r in stats)


def test_freshness_and_volume(spark):
    days = [dt.datetime(2024, 1, 1, 5)] * 2 + [dt.datetime(2024, 1, 2)] * 5 + [dt.datetime(2024, 1, 4)]
    df = spark.createDataFrame([(d,) for d in days], "at timestamp")
    assert freshness(df, "at", "2024-01-04 00:01:30").collect()[0]["lag_seconds"] == 90
    got = {r["day"].day: (r["records"], r["previous"], r["growth"]) for r in volume_daily(df, "at").collect()}
    assert got == {1: (2, None, None), 2: (5, 2, 3), 4: (1, None, None)}


def test_profile(spark):
    got = quality.profile(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "t").collect()
    assert [(r["column"], r["type"], r["records"], r["filled"]) for r in got] == [("a", "int", 2, 2), ("b", "string", 2, 1)]
