from __future__ import annotations

import math

from pyspark.sql import functions as F

from tillflow.functions.money import line_total, money_avg, money_sum, rounded
from tillflow.operators.cleaning import quarantine, silver, stream_filter
from tillflow.operators.monitoring import dq_metrics
from tillflow.schemas import BRONZE, SILVER_COLUMNS, WIRE, silver_schema

RUN = "2026-01-01 00:00:00"
WHEN = "2024-05-06T07:08:09.123456"


def purchases(spark, *rows):
    return spark.createDataFrame(rows, WIRE["purchases"])


def test_purchase_rules_keep_unknown_numbers(spark):
    df = purchases(
        spark,
        (" a ", "u", WHEN, 1, 1, 0.0),
        ("b", "u", WHEN, 1, None, 1.0),
        ("c", "u", WHEN, 1, 2, None),
        ("d", "u", WHEN, 1, 0, 1.0),
        ("e", "u", WHEN, 1, -1, 1.0),
        ("f", "u", WHEN, 1, 1, -0.01),
        ("g", "u", None, 1, 1, 1.0),
        ("h", "u", "garbage", 1, 1, 1.0),
        ("  ", "u", WHEN, 1, 1, 1.0),
        ("i", None, WHEN, 1, 1, 1.0),
    )
    kept = {r["order_id"]: r for r in silver("purchases", df, RUN).collect()}
    assert set(kept) == {"a", "b", "c"}
    assert kept["b"]["total_amount"] is None and kept["b"]["unit_price"] == 1.0
    assert kept["a"]["timestamp"].microsecond == 123456
    assert (kept["a"]["purchase_date"], kept["a"]["purchase_hour"]) == ("2024-05-06", 7)
    reasons = {r["order_id"]: r["failed_rule"] for r in quarantine("purchases", df).collect()}
    assert reasons == {
        "d": "quantity not positive", "e": "quantity not positive", "f": "price negative",
        "g": "timestamp missing", "h": "timestamp missing", "": "order_id missing", "i": "user_id missing",
    }
    assert len(kept) + len(reasons) == df.count()


def test_silver_schemas(spark):
    for entity in WIRE:
        df = silver(entity, spark.createDataFrame([], WIRE[entity]), RUN)
        assert df.columns == SILVER_COLUMNS[entity]
        assert [f.dataType for f in df.schema] == [f.dataType for f in silver_schema(entity)]


def test_email_rule(spark):
    emails = {
        " A.B+c@X-y.CO ": True, "a@b": False, "a@b.museums": False, "a@b.museum": True, "": False, None: False,
        "no-at.example.com": False,
    }
    df = spark.createDataFrame(
        [(str(i), "n", e, " fr ", "2020-02-03") for i, e in enumerate(emails)], WIRE["customers"]
    )
    kept = {int(r["customer_id"]): r for r in silver("customers", df, RUN).collect()}
    assert set(kept) == {i for i, ok in enumerate(emails.values()) if ok}
    assert (kept[0]["email"], kept[0]["email_domain"], kept[0]["country"]) == ("a.b+c@x-y.co", "x-y.co", "FR")
    assert (kept[0]["signup_year"], kept[0]["signup_month"], kept[0]["signup_day"]) == (2020, 2, 3)


def test_clickstream_normalises_type_and_keeps_tabs(spark):
    rows = [(" u ", WHEN, " p ", " click ", 1, "s"), ("\t", WHEN, "p", "view", 1, "s"), (" ", WHEN, "p", "x", 1, "s")]
    got = silver("clickstream", spark.createDataFrame(rows, WIRE["clickstream"]), RUN).collect()
    assert [(r["user_id"], r["event_type"], r["page_url"]) for r in got] == [("u", "CLICK", "p"), ("\t", "VIEW", "p")]


def test_stream_filter_drops_unknown_quantity(spark):
    rows = [("a", "u", None, 1, None, 1.0), ("b", "u", None, 1, 0, 1.0), ("c", None, None, 1, 1, -1.0)]
    df = spark.createDataFrame(rows, BRONZE["purchases"])
    assert [r["order_id"] for r in stream_filter("purchases", df).collect()] == ["c"]


def test_rounding_equals_round(spark):
    special = [1.005, 2.675, 0.285, 0.1, 0.0, 1e15 + 0.37, 9e15, 1e300, float("nan"), float("inf")]
    prices = special + [-x for x in special] + [i * 0.005 for i in range(500)] + [i / 7 for i in range(500)]
    df = spark.createDataFrame([(q, p) for p in prices for q in (1, 3, 7, None)], "q int, p double")
    p, q = F.col("p"), F.col("q")
    wrong = df.select(
        "q", "p", rounded(p).alias("a"), F.round(p, 2).alias("b"), line_total(q, p).alias("c"), F.round(q * p, 2).alias("d")
    ).where("NOT (a <=> b AND c <=> d)")
    assert wrong.collect() == []


def test_money_sum_is_exact_and_falls_back(spark):
    df = spark.createDataFrame(
        [("cents", 0.1)] * 10 + [("fine", 0.001), ("fine", 0.1)] + [("nan", float("nan")), ("nan", 1.0), ("none", None)],
        "k string, x double",
    )
    got = {
        r["k"]: (r["s"], r["m"])
        for r in df.groupBy("k").agg(money_sum(F.col("x")).alias("s"), money_avg(F.col("x")).alias("m")).collect()
    }
    assert got["cents"] == (1.0, 0.1)
    assert math.isclose(got["fine"][0], 0.101)
    assert math.isnan(got["nan"][0])
    assert got["none"] == (None, None)


def test_dq_metrics(spark):
    df = purchases(spark, ("a", "u", WHEN, 1, 1, 1.0), (None, None, WHEN, 1, 0, 1.0))
    got = {(r["metric"], r["name"]): (r["records"], r["ratio"]) for r in dq_metrics("purchases", df).collect()}
    assert got["failed_rule", "order_id missing"] == (1, 0.5)
    assert got["failed_rule", "user_id missing"] == (0, 0.0)
    assert got["filled", "quantity"] == (2, 1.0)
