"""Windows without a state store, and large batches in steps whose shuffle files go at once."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.compare import difference
from tests.test_cluster_paths import con, tables  # noqa: F401 - fixtures
from tillflow import session as settings
from tillflow.operators.analytics import clickstream_analytics, customer_analytics, flatten_window, purchase_analytics
from tillflow.plans import registry
from tillflow.schemas import BRONZE, KEYS
from tillflow.session import streaming_session
from tillflow.sources import sample
from tillflow.sources.messages import decode_json
from tillflow.streaming.jobs import await_all, start_analytics, start_layers
from tillflow.streaming.sinks import ONCE_THROUGH, read_batches, read_keyed, read_snapshot, stream_to_files
from tillflow.streaming.windows import start_windows

QUERIES, SQL = entry.queries(), entry.oracle_sql()
RUN = "2026-01-01 00:00:00"
SALE = "order_id string, user_id string, timestamp timestamp, product_id int, quantity int, price double"
CLICK = "user_id string, timestamp timestamp, page_url string, event_type string, product_id int, session_id string"
CUSTOMER = "customer_id string, name string, email string, country string, signup_date timestamp"


def at(minute, second=0):
    return datetime(2024, 1, 1, 12) + timedelta(minutes=minute, seconds=second)


def put(spark, folder, number, rows, schema):
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{number}")


def source(session, folder, schema):
    return session.readStream.schema(schema).parquet(f"{folder}/*")


def sale(n, time, product=1):
    return (f"o{n}", "u", time, product, n % 3, 1.25)


def measure(rows):
    return purchase_analytics(rows, RUN)


def sales_schema(spark):
    return flatten_window(measure(spark.createDataFrame([], SALE))).schema


def rows_of(df):
    return sorted(map(str, df.collect()))


def shuffles(spark):
    """Those that have files on the disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name.split("_")[1] for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


DELIVERED = [
    [sale(1, at(0)), sale(2, at(10)), sale(3, None), sale(4, datetime(1960, 1, 1)), sale(5, at(9, 59))],
    # the watermark is 12:09 now: windows that end there or before are closed, others take more rows
    [sale(6, at(8, 59)), sale(7, at(9)), sale(8, at(9, 59)), sale(9, at(10, 1), 2), sale(10, None)],
    [sale(11, at(10, 5)), sale(12, at(30)), sale(13, at(1)), sale(14, None, None), sale(15, at(29), None)],
    [sale(16, at(28, 30)), sale(17, at(29, 1), None), sale(18, at(5))],
]


@pytest.mark.parametrize("step_rows", [1, 1_000])
def test_windows_are_those_of_a_state_store(spark, folder, monkeypatch, step_rows):
    monkeypatch.setattr(settings, "STEP_ROWS", step_rows)
    for number, rows in enumerate(DELIVERED):
        put(spark, f"{folder}/in", number, rows, SALE)
        df = source(streaming_session(spark), f"{folder}/in", SALE)
        await_all([stream_to_files(measure(df), f"{folder}/state", f"{folder}/k0", ONCE_THROUGH)])
        for _ in range(2):  # the second time finds nothing new
            await_all([start_windows(df, "timestamp", measure, f"{folder}/own", f"{folder}/k1", ONCE_THROUGH)])
        want, got = (rows_of(read_batches(spark, f"{folder}/{p}", sales_schema(spark))) for p in ("state", "own"))
        assert got == want and got
    assert len(got) == 4
    assert not os.path.exists(f"{folder}/k1/state") and os.listdir(f"{folder}/k1/held") == []
    assert sorted(n for n in os.listdir(f"{folder}/k1/open") if not n.startswith(".")) == ["2", "3"]
    assert {r["order_id"] for r in spark.read.parquet(f"{folder}/k1/open/3").collect()} == {"o12", "o15", "o17"}


def test_a_batch_that_failed_halfway_runs_again(spark, folder):
    def run(how):
        df = source(streaming_session(spark), f"{folder}/in", SALE)
        await_all([start_windows(df, "timestamp", how, f"{folder}/out", f"{folder}/k", ONCE_THROUGH)])

    def fails(rows):
        raise RuntimeError("lost before its windows")

    for number, rows in enumerate(DELIVERED[:3]):
        put(spark, f"{folder}/in", number, rows, SALE)
        with pytest.raises(Exception, match="lost before"):
            run(fails)
        run(measure)
    got = {(r["window_start"].minute, r["product_id"]): r["order_count"] for r in read_batches(spark, f"{folder}/out", sales_schema(spark)).collect()}
    assert got == {(0, 1): 1, (9, 1): 3, (10, 1): 2, (10, 2): 1}


def test_the_checkpoint_of_a_state_store_is_refused(spark, folder):
    put(spark, f"{folder}/in", 0, DELIVERED[0], SALE)
    df = source(streaming_session(spark), f"{folder}/in", SALE)
    await_all([stream_to_files(df, f"{folder}/out", f"{folder}/k", ONCE_THROUGH)])
    put(spark, f"{folder}/in", 1, DELIVERED[1], SALE)
    with pytest.raises(Exception, match="no open windows"):
        await_all([start_windows(df, "timestamp", measure, f"{folder}/out", f"{folder}/k", ONCE_THROUGH)])


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_the_analytics_job_keeps_open_windows_only(spark, folder, monkeypatch, distinct):
    """before, all events of a delivery went to a state store, each under its user and its session."""
    monkeypatch.setattr(settings, "STEP_ROWS", 20)
    clicks = [(f"u{i % 7}" if i % 5 else None, at(i // 4, i % 60), f"p{i % 2}", ("click", None)[i % 3 == 0], 1, f"s{i % 4}") for i in range(80)]
    put(spark, f"{folder}/clickstream", 0, clicks, CLICK)
    put(spark, f"{folder}/purchases", 0, [sale(i, at(i % 31), i % 4) for i in range(90)], SALE)
    put(spark, f"{folder}/customers", 0, [(f"c{i}", "n", "e", f"k{i % 3}", at(0)) for i in range(10)], CUSTOMER)
    session, before = streaming_session(spark), shuffles(spark)
    streams = {e: source(session, f"{folder}/{e}", s) for e, s in (("clickstream", CLICK), ("purchases", SALE), ("customers", CUSTOMER))}
    await_all(start_analytics(streams, f"{folder}/out", f"{folder}/k", ONCE_THROUGH, distinct=distinct, run_ts=RUN))
    assert len(shuffles(spark) - before) <= 1  # that of the snapshot, whose state is Spark's
    for name, entity, schema, how, last in (
        ("clickstream_analytics", "clickstream", CLICK, lambda rows: clickstream_analytics(rows, RUN, distinct), at(18, 19)),
        ("purchase_analytics", "purchases", SALE, measure, at(29)),
    ):
        whole = flatten_window(how(spark.read.schema(schema).parquet(f"{folder}/{entity}/*")))
        want = rows_of(whole.where(F.col("window_end") <= F.lit(last)))
        assert rows_of(read_batches(spark, f"{folder}/out/{name}", whole.schema)) == want and len(want) > 10
        assert not os.path.exists(f"{folder}/k/{name}/state")
        assert spark.read.parquet(f"{folder}/k/{name}/open/0").count() < 10
    shot = read_snapshot(spark, f"{folder}/out/customer_analytics", customer_analytics(spark.createDataFrame([], CUSTOMER), RUN).schema)
    assert sorted((r["country"], r["customer_count"]) for r in shot.collect()) == [("k0", 4), ("k1", 3), ("k2", 3)]


MESSAGE = "value binary, timestamp timestamp, partition int, offset bigint"


def message(n, key, quantity):
    text = '{"order_id":%s,"user_id":"u","timestamp":"2024-01-01","product_id":1,"quantity":%d,"price":1.5}' % (key, quantity)
    return (bytearray(text.encode()), at(n % 3), n % 2, n)


def test_layers_in_steps(spark, folder, monkeypatch):
    """before, a batch was kept whole in memory and on disk, and the shuffle files of its keyed copy stayed."""
    monkeypatch.setattr(settings, "STEP_ROWS", 10)
    schema, session = BRONZE["purchases"], streaming_session(spark)
    numbers = [(n, f'"o{n % 17}"' if n % 10 else "null", n % 4) for n in range(60)]
    for number, rows in enumerate((numbers[:45], numbers[45:])):
        put(spark, f"{folder}/in", number, [message(*r) for r in rows], MESSAGE)
        before = shuffles(spark)
        stream = decode_json(source(session, f"{folder}/in", MESSAGE), "purchases")
        await_all([start_layers("purchases", stream, f"{folder}/lake", f"{folder}/k", trigger=ONCE_THROUGH)])
        assert shuffles(spark) <= before and spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    assert os.listdir(f"{folder}/k/held") == []
    assert not any("_steps" in name for _, names, _ in os.walk(f"{folder}/lake") for name in names)
    whole = decode_json(spark.read.schema(MESSAGE).parquet(f"{folder}/in/*"), "purchases").select(schema.names)
    assert rows_of(read_batches(spark, f"{folder}/lake/bronze/purchases", schema)) == rows_of(whole)
    assert rows_of(read_batches(spark, f"{folder}/lake/silver/purchases", schema)) == rows_of(whole.where("quantity > 0"))
    # of each delivery the last by time, partition and offset; the second delivery is newer than the first
    last = {}
    for rows in (numbers[:45], numbers[45:]):
        last |= {key.strip('"'): quantity for n, key, quantity in sorted(rows, key=lambda r: (r[0] % 3, r[0] % 2, r[0])) if key != "null"}
    got = read_keyed(spark, f"{folder}/lake/keyed/purchases", schema, KEYS["purchases"])
    assert {r["order_id"]: r["quantity"] for r in got.collect()} == last


def test_messages_in_steps(spark, tables, monkeypatch):
    monkeypatch.setattr(settings, "STEP_ROWS", 300)
    whole, parts = (f(spark, tables, "purchases") for f in (sample.messages, sample.message_steps))
    assert len(parts) == 3 and all(0 < part.count() < whole.count() for part in parts)
    assert sorted(r for part in parts for r in rows_of(part)) == rows_of(whole)
    assert len(sample.message_steps(spark, tables, "customers")) == 1


def test_deliveries(spark, folder):
    rows = [(bytearray(b"x"), at(0), 0, n, time, last) for n, (time, last) in enumerate(
        [(at(0), False), (at(7), False), (None, False), (at(10), False), (at(1), True), (at(99), True), (at(2), None), (None, True)]
    )]
    found = spark.createDataFrame(rows, f"{MESSAGE}, at timestamp, last boolean")
    offsets = lambda path: sorted(r["offset"] for r in spark.read.parquet(path).collect())
    for steps in (None, [found.where("offset < 4"), found.where("offset >= 4")]):
        out = f"{folder}/{steps is None}"
        paths = sample.write_deliveries(found, f"{out}/last", 2, "last", steps)
        assert [offsets(p) for p in paths] == [[0, 2], [1, 3], [4, 5, 7]]
        (path,) = sample.write_deliveries(found.drop("last"), f"{out}/one", 1, steps=steps and [s.drop("last") for s in steps])
        assert offsets(path) == list(range(8)) and spark.read.parquet(path).columns == ["value", "timestamp", "partition", "offset"]
    assert sample.write_deliveries(found.drop("last").where("false"), f"{folder}/none", 1) == []


@pytest.mark.parametrize("name", ["stream_late_rows", "stream_analytics_job", "stream_analytics_job_clickstream", "stream_analytics_job_purchases", "stream_layers_silver"])
def test_queries_in_steps(spark, tables, con, monkeypatch, name):
    """the same rows as by SQL, whatever the size of a step; no window ever is state."""
    monkeypatch.setattr(settings, "STEP_ROWS", 250)
    monkeypatch.setattr(registry, "_job_roots", {})
    stored, given = [], registry.Models.stored
    monkeypatch.setattr(registry.Models, "stored", lambda m, kind: stored.append((kind, given(m, kind))) or stored[-1][1])
    assert difference(QUERIES[name](spark, tables), con, SQL[name]) is None
    checkpoints = [path.removeprefix("file:") for kind, path in stored if kind.startswith("checkpoint")]
    state = [at for path in checkpoints for at, names, _ in os.walk(path) if "state" in names and not at.endswith("customer_analytics")]
    assert checkpoints and state == []
