"""Queries that store what they derive, on a cluster whose ``spark.checkpoint.dir`` names no file system."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck
from tillflow.plans import registry
from tillflow.sinks import folders

QUERIES, SQL = entry.queries(), entry.oracle_sql()
DAY = datetime(1997, 12, 20)

TABLES = {
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", 0) for i in range(8)]),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(i, f"Customer#{i:09d}", i % 8, 1.5 * i, ("BUILDING", "MACHINERY")[i % 2]) for i in range(60)],
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(i, f"part {i}", "Brand#1", "SMALL", i, 900.25 + i) for i in range(100)],
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(i, i * 7 % 60, "F", 10.5, DAY + timedelta(days=i % 40), "3-MEDIUM") for i in range(90)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [
            (i % 90, i * 11 % 100, i % 50, i % 7 + 1, float(i % 50 + 1), 100.25 + i, 0.0, 0.0, "N", "O", DAY + timedelta(days=i % 61))
            for i in range(700)
        ],
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
        [
            (i, datetime(2024, 1, 1) + timedelta(minutes=37 * i), i % 60, ("view", "signup", "error", "click")[i % 4], 1.0, f'{{"k": {i % 50}}}')
            for i in range(300)
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, (schema, found) in TABLES.items():
        spark.createDataFrame(found, schema).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture(scope="module")
def con(tables):
    con = duck("/nowhere")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{tables}/{name}.parquet/*.parquet')")
    return con


@pytest.fixture
def cluster(spark, folder, monkeypatch):
    """The session as on a cluster: not a local master, and a folder without a scheme."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: f"{folder}/checkpoints")
    return spark


NAMES = [
    "batch_silver_clickstream",
    "batch_silver_customers",
    "batch_silver_purchases",
    "batch_summary",
    "bronze_append",
    "bronze_full_clickstream",
    "bronze_append_rows",
    "bronze_full",
    "bronze_full_customers",
    "bronze_full_purchases",
    "csv_declared",
    "csv_header",
    "csv_inferred",
    "daily_incremental",
    "csv_typed",
    "export_fct_purchases",
    "export_gold",
    "export_dim_customers",
    "export_manifest",
    "file_stats",
    "gold_job",
    "keyed_load",
]


@pytest.mark.parametrize("name", NAMES)
def test_query_on_a_cluster(cluster, tables, con, name):
    assert difference(QUERIES[name](cluster, tables), con, SQL[name]) is None


def test_keyed_load_sorts_in_as_many_tasks_as_the_session_asks_for(spark, tables, monkeypatch):
    written, write = [], registry.write_csv
    monkeypatch.setattr(registry, "write_csv", lambda df, path: (written.append(path), write(df, path)))
    conf = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        QUERIES["keyed_load"](spark, tables)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    (path,) = [p for p in written if p.endswith("purchases.csv")]
    assert sum(name.startswith("part-") for name in folders.names(spark, path)) == 9
