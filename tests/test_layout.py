"""Tables in date folders, tables along a curve, counts taken while writing and counts from footers."""

from __future__ import annotations

import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillflow.operators import quality
from tillflow.plans import jobs, retention
from tillflow.sinks.curve import files_to_read, place, range_bounds, write_curve
from tillflow.sinks.tables import profile_measures, write_counted, write_table
from tillflow.sources.files import stored_tables

DAY = ["y", "m", "d"]


def events(spark, path, columns=DAY, step="6 hours"):
    """A row every six hours over 20 days around the turn of a year, and two without a time."""
    times = spark.sql(f"select explode(sequence(timestamp'2023-12-22 00:00:00', timestamp'2024-01-10 18:00:00', interval {step})) as t")
    rows = times.unionByName(spark.createDataFrame([(None,), (None,)], "t timestamp")).withColumn("v", F.hash("t"))
    parts = {"y": F.year("t"), "m": F.month("t"), "d": F.day("t")}
    write_table(rows.withColumns({c: parts[c] for c in columns}), path, partition_by=columns)
    return {r["t"] for r in rows.collect() if r["t"]}


def files(path):
    return {f: os.stat(f).st_ino for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def left(spark, path):
    return sorted(r["t"] for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("as_of, done", [
    ("2024-01-08 09:30:00", {"removed": 11, "rewritten": 1, "left": 9}),
    (datetime(2024, 1, 8), {"removed": 11, "rewritten": 0, "left": 10}),
    (date(2024, 1, 8), {"removed": 11, "rewritten": 0, "left": 10}),
    ("2024-01-08 18:00:01", {"removed": 12, "rewritten": 0, "left": 9}),
    ("2030-01-01", {"removed": 21, "rewritten": 0, "left": 0}),
    ("2020-01-01", {"removed": 1, "rewritten": 0, "left": 20}),
])
def test_folders_go_and_one_is_rewritten(spark, folder, as_of, done):
    path = f"{folder}/t"
    times, before = events(spark, path), None
    before, least = files(path), retention.bound(as_of, 7)
    assert retention.remove_old_folders(spark, path, DAY, "t", as_of, 7) == done
    if done["left"] + done["rewritten"]:
        assert left(spark, path) == sorted(t for t in times if t >= least)
    after = files(path)
    same = [f for f in after if before.get(f) == after[f]]
    assert len(after) - len(same) <= done["rewritten"]
    # a second run finds nothing to do but the folder that the bound falls in
    again = retention.remove_old_folders(spark, path, DAY, "t", as_of, 7)
    assert again == {**done, "removed": 0}


@pytest.mark.parametrize("columns", [["y"], ["y", "m"]])
def test_folders_by_year_and_month(spark, folder, columns):
    path = f"{folder}/t"
    times = events(spark, path, columns)
    done = retention.remove_old_folders(spark, path, columns, "t", "2024-01-11", 15)
    assert done == {"removed": 1, "rewritten": 1, "left": 1}
    assert left(spark, path) == sorted(t for t in times if t >= datetime(2023, 12, 27))


def test_span_of_folders():
    assert retention.span(("2023", "12")) == (datetime(2023, 12, 1), datetime(2024, 1, 1))
    assert retention.span(("2024", "2", "29")) == (datetime(2024, 2, 29), datetime(2024, 3, 1))
    assert retention.span(("1999",)) == (datetime(1999, 1, 1), datetime(2000, 1, 1))


def test_job_takes_flat_tables_and_folders(spark, folder):
    events(spark, f"{folder}/dated")
    write_table(spark.read.parquet(f"{folder}/dated").drop(*DAY), f"{folder}/flat")
    for name, by in (("dated", DAY), ("flat", None)):
        jobs.remove_old(spark, f"{folder}/{name}", "t", "2024-01-08 09:30:00", 7, by)
    assert left(spark, f"{folder}/dated") == left(spark, f"{folder}/flat")


def wide(spark, n=20_000):
    spread = lambda salt, size: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(size))
    rows = spark.range(n).select(
        "id", spread(1, 5_000).alias("a"), F.format_string("user-%05d", spread(2, 4_000)).alias("b"), spread(3, 3_000).cast("int").alias("c"), (F.col("id") % 2).alias("y")
    )
    return rows.withColumn("b", F.when(F.col("id") % 50 == 0, None).otherwise(F.col("b")))


def scanned_rows(df):
    """Rows that the scan of an executed plan has given out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_look_ups_by_every_attribute_skip_most_files(spark, folder):
    path, source = f"{folder}/t", f"{folder}/s"
    wide(spark).write.parquet(source)
    rows = spark.read.parquet(source)
    assert write_curve(rows, path, ["a", "b", "c"], ["y"], files=128) == 20_000
    table = spark.read.parquet(path)
    assert table.count() == 20_000 and table.select(rows.columns).exceptAll(rows).isEmpty()
    some = rows.where("b is not null").first()
    for column in ("a", "b", "c"):
        value = some[column]
        found = files_to_read(table, column, value).first()
        # 64 files of a folder cut each of the three attributes in four; a look-up meets one or two of these quarters
        assert found["files"] >= 100 and found["read"] * 2 <= found["files"]
        hits = table.where(F.col(column) == F.lit(value))
        assert sorted(r["id"] for r in hits.collect()) == sorted(r["id"] for r in rows.where(F.col(column) == F.lit(value)).collect())
        assert scanned_rows(table.where(F.col(column) == F.lit(value))) * 2 <= 20_000


def test_places_follow_ranges(spark):
    rows = spark.range(64).select(F.col("id").alias("a"), (63 - F.col("id")).alias("b"), F.lit(5).alias("same"), F.lit(None).cast("int").alias("none"))
    bounds, n = range_bounds(rows, ["a", "b", "same", "none"], bits=2)
    assert n == 64 and bounds["a"] == [16, 32, 48] and bounds["none"] == [] and bounds["same"] == [5]
    places = [r[0] for r in rows.orderBy("a").select(place({"a": bounds["a"]}, 2)).collect()]
    assert places == [i // 16 for i in range(64)]
    both = {r["a"]: r["p"] for r in rows.select("a", place({k: bounds[k] for k in "ab"}, 2).alias("p")).collect()}
    assert len(set(both.values())) >= 4 and both[0] < both[63]


def test_curve_of_an_empty_table(spark, folder):
    empty = wide(spark, 0)
    assert write_curve(empty, f"{folder}/t", ["a", "b"], files=4) == 0


@pytest.mark.parametrize("fmt, by", [("parquet", None), ("parquet", ["y"]), ("csv", None)])
def test_counts_are_taken_while_writing(spark, folder, fmt, by):
    rows = wide(spark, 3_000)
    seen = write_counted(rows, f"{folder}/t", fmt, by, **profile_measures(rows), largest=F.max("id"))
    assert seen["rows"] == 3_000 and seen["largest"] == 2_999
    assert [seen[f"filled_{i}"] for i in range(5)] == [3_000, 3_000, 2_940, 3_000, 3_000]
    assert spark.read.format(fmt).option("header", True).load(f"{folder}/t").count() == 3_000


def test_counts_of_no_rows(spark, folder):
    rows = wide(spark, 10).where("id < 0")
    assert write_counted(rows, f"{folder}/t", **profile_measures(rows))["rows"] == 0


def test_counts_come_from_footers(spark, folder):
    write_table(wide(spark, 3_000), f"{folder}/flat")
    write_table(wide(spark, 500), f"{folder}/dated", partition_by=["y"])
    tables = stored_tables(spark, {name: f"{folder}/{name}" for name in ("flat", "dated")})
    counts = quality.row_counts(tables)
    assert {r["table"]: r["records"] for r in counts.collect()} == {"flat": 3_000, "dated": 500}
    assert pushed(spark, counts) == 2
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def pushed(spark, df):
    """Scans that take over the count."""
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(formatted).count("PushedAggregation: [COUNT(*)]")


def test_presence_comes_from_footers(spark, folder):
    from tillflow.schemas import silver_schema

    for entity, n in (("purchases", 7), ("customers", 0)):
        write_table(spark.createDataFrame([tuple([None] * len(silver_schema(entity)))] * n, silver_schema(entity)), f"{folder}/{entity}")
    found = jobs.run_silver_checks(spark, folder)
    assert {(r["table"], r["present"], r["records"], r["ok"]) for r in found.collect()} == {("clickstream", False, 0, False), ("purchases", True, 7, True), ("customers", True, 0, False)}
    assert pushed(spark, found) == 2
