from __future__ import annotations

import json
import os

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from tillflow.operators.analytics import (
    clickstream_analytics, customer_analytics, flatten_window, purchase_analytics,
)
from tillflow.operators.keyed import upsert
from tillflow.plans import jobs
from tillflow.schemas import BRONZE, ENTITIES, KEYS, WIRE
from tillflow.sources.messages import decode_json, folder_source, kafka_source
from tillflow.streaming.jobs import await_all, start_analytics, start_medallion
from tillflow.streaming.jobs import start_layers
from tillflow.streaming.sinks import (
    ONCE_THROUGH, batches_of, compact_keyed, read_batches, read_keyed, read_snapshot, stream_snapshot, stream_to_files, stream_upsert,
)

RUN = "2026-01-01 00:00:00"


def deliver(folder, number, records):
    """One file of messages; file times decide the order in which a stream takes them."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{number:03d}.json"
    with open(path, "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def click(user, time, kind="click", page="p", session=None):
    return {"user_id": user, "timestamp": time, "page_url": page, "event_type": kind, "product_id": 1, "session_id": session or user}


def purchase(order, time, quantity=1, price=0.5, product=1):
    return {"order_id": order, "user_id": "u", "timestamp": time, "product_id": product, "quantity": quantity, "price": price}


def arriving(spark, folder, entity, one_file_per_batch=True):
    return decode_json(folder_source(spark, folder, 1 if one_file_per_batch else None), entity)


def stream(spark, folder, entity, one_file_per_batch=True):
    return arriving(spark, folder, entity, one_file_per_batch).drop("arrival")


def test_decode_malformed_messages(spark):
    messages = ['{"order_id": 7, "product_id": "12", "quantity": 2, "timestamp": "nope"}', "not json", "{}"]
    df = spark.createDataFrame([(m.encode(),) for m in messages], "value binary")
    got = decode_json(df, "purchases")
    assert [f.dataType for f in got.schema] == [f.dataType for f in BRONZE["purchases"]]
    rows = got.collect()
    assert (rows[0]["order_id"], rows[0]["quantity"], rows[0]["timestamp"]) == ("7", 2, None)
    assert all(v is None for v in rows[1]) and all(v is None for v in rows[2])


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        kafka_source(spark, "purchases", "broker:9092")


@pytest.mark.parametrize("distinct", ["exact", "approx"])
def test_closed_windows_equal_batch(spark, folder, distinct):
    for n in range(4):
        deliver(f"{folder}/in", n, [
            click(f"u{i % 3}" if i % 4 else None, f"2024-01-01T00:{2 * n + i % 2:02d}:{i:02d}", ["click", "purchase"][i % 2], session=f"s{i % 5}")
            for i in range(40)
        ])
    source = stream(spark, f"{folder}/in", "clickstream")
    await_all([stream_to_files(clickstream_analytics(source, RUN, distinct), f"{folder}/out", f"{folder}/ckpt", ONCE_THROUGH)])
    batch = flatten_window(clickstream_analytics(decode_json(spark.read.text(f"{folder}/in"), "clickstream"), RUN))
    newest = decode_json(spark.read.text(f"{folder}/in"), "clickstream").agg(F.max("timestamp")).collect()[0][0]
    want = batch.where(F.col("window_end") <= F.lit(newest) - F.expr("INTERVAL 1 MINUTE"))
    got = read_batches(spark, f"{folder}/out", batch.schema)
    assert want.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_window_edges(spark):
    rows = [click("a", "2024-01-01 00:00:00"), click("b", "2024-01-01 00:00:59.999999"), click("c", "2024-01-01 00:01:00")]
    df = decode_json(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"), "clickstream")
    got = clickstream_analytics(df, RUN).orderBy("window").collect()
    assert [(r["event_count"], r["unique_users"], r["engagement_score"], r["hour_of_day"], r["day_of_week"]) for r in got] == [
        (2, 2, 4, 0, 2), (1, 1, 2, 0, 2),
    ]


def test_late_event_is_dropped_in_a_later_batch(spark, folder):
    deliver(f"{folder}/in", 0, [purchase("a", "2024-01-01T00:00:10")])
    deliver(f"{folder}/in", 1, [purchase("b", "2024-01-01T00:10:00")])
    deliver(f"{folder}/in", 2, [purchase("c", "2024-01-01T00:20:00")])
    # Lateness is judged by the watermark of the batch before, which has passed 00:01 by now.
    deliver(f"{folder}/in", 3, [purchase("late", "2024-01-01T00:00:20"), purchase("d", "2024-01-01T00:30:00")])
    sales = purchase_analytics(stream(spark, f"{folder}/in", "purchases"), RUN)
    await_all([stream_to_files(sales, f"{folder}/out", f"{folder}/ckpt", ONCE_THROUGH)])
    got = spark.read.parquet(f"{folder}/out").orderBy("window_start").collect()
    assert [(r["window_start"].minute, r["order_count"]) for r in got] == [(0, 1), (10, 1), (20, 1)]


def test_restart_adds_nothing_twice(spark, folder):
    def run():
        source = stream(spark, f"{folder}/in", "purchases")
        await_all([stream_to_files(source, f"{folder}/out", f"{folder}/ckpt", ONCE_THROUGH)])
        return spark.read.parquet(f"{folder}/out").count()

    deliver(f"{folder}/in", 0, [purchase("a", "2024-01-01T00:00:10")])
    assert run() == 1
    assert run() == 1
    deliver(f"{folder}/in", 1, [purchase("b", "2024-01-01T00:00:10")])
    assert run() == 2


def quantities(df):
    return {(r["order_id"], r["quantity"]) for r in df.collect()}


def test_last_arrival_wins(spark, folder):
    """Also where the later row sorts lower, and where its event is older."""
    deliver(f"{folder}/in", 0, [purchase("a", "2024-01-01T00:00:10", 2), purchase("a", "2024-01-01T00:00:10", 1), purchase("b", "2024-01-01T00:00:10", 1)])
    deliver(f"{folder}/in", 1, [purchase("b", "2023-01-01T00:00:00", 9), "junk"])
    keys, schema, path = KEYS["purchases"], BRONZE["purchases"], f"{folder}/keyed"
    run = lambda: await_all([
        stream_upsert(arriving(spark, f"{folder}/in", "purchases"), keys, ["arrival"], path, f"{folder}/ckpt", ONCE_THROUGH, columns=schema.names)
    ])
    run()
    assert quantities(read_keyed(spark, path, schema, keys)) == {("a", 1), ("b", 9)}
    # Folded in place, the table is the same, and the stream goes on from it.
    assert compact_keyed(spark, path, schema, keys) == 2 and len(batches_of(spark, path)) == 1
    assert quantities(read_keyed(spark, path, schema, keys)) == {("a", 1), ("b", 9)}
    deliver(f"{folder}/in", 2, [purchase("a", "2024-01-01T00:00:10", 5)])
    run()
    assert quantities(read_keyed(spark, path, schema, keys)) == {("a", 5), ("b", 9)}
    assert compact_keyed(spark, path, schema, keys) == 2
    assert quantities(spark.read.parquet(path)) == {("a", 5), ("b", 9)}


def test_upsert_wants_an_order(spark, folder):
    deliver(f"{folder}/in", 0, [purchase("a", "2024-01-01T00:00:10")])
    source = stream(spark, f"{folder}/in", "purchases")
    with pytest.raises(ValueError, match="order"):
        stream_upsert(source, KEYS["purchases"], [], f"{folder}/keyed", f"{folder}/ckpt")
    with pytest.raises(ValueError, match="order"):
        start_layers("purchases", source, f"{folder}/lake", f"{folder}/ckpt")


def test_new_checkpoint_loses_nothing(spark, folder):
    """The second run counts its batches from 0 again, over a source that has only the new messages."""
    deliver(f"{folder}/one", 0, [purchase("a", "2024-01-01T00:00:10"), purchase("b", "2024-01-01T00:00:10")])
    deliver(f"{folder}/two", 0, [purchase("c", "2024-01-01T00:00:10"), purchase("b", "2024-01-01T00:00:10", 7)])
    keys, schema = KEYS["purchases"], BRONZE["purchases"]
    for name in ("one", "two", "two"):  # the third run is a restart
        source = arriving(spark, f"{folder}/{name}", "purchases")
        await_all([
            stream_upsert(source, keys, ["arrival"], f"{folder}/keyed", f"{folder}/k{name}", ONCE_THROUGH, columns=schema.names),
            start_layers("purchases", source, f"{folder}/lake", f"{folder}/l{name}", trigger=ONCE_THROUGH),
            stream_to_files(source.drop("arrival"), f"{folder}/files", f"{folder}/f{name}", ONCE_THROUGH),
            stream_snapshot(customer_analytics(source.selectExpr("product_id AS country", "order_id AS customer_id"), RUN), f"{folder}/shot", f"{folder}/s{name}", ONCE_THROUGH),
        ])
    want = {("a", 1), ("b", 7), ("c", 1)}
    assert quantities(read_keyed(spark, f"{folder}/keyed", schema, keys)) == want
    assert quantities(read_keyed(spark, f"{folder}/lake/keyed/purchases", schema, keys)) == want
    for path in ("files", "lake/bronze/purchases", "lake/silver/purchases"):
        assert sorted(r["order_id"] for r in read_batches(spark, f"{folder}/{path}", schema).collect()) == ["a", "b", "b", "c"]
    (newest,) = read_snapshot(spark, f"{folder}/shot", customer_analytics(spark.createDataFrame([], "country int, customer_id string"), RUN).schema).collect()
    assert newest["customer_count"] == 2


def test_superseded_snapshots_go(spark, folder):
    for n in range(4):
        deliver(f"{folder}/in", n, [{"customer_id": f"c{n}", "country": "fr", "email": "e"}])
    source = stream(spark, f"{folder}/in", "customers")
    await_all([stream_snapshot(customer_analytics(source, RUN), f"{folder}/shot", f"{folder}/ckpt", ONCE_THROUGH)])
    assert len(batches_of(spark, f"{folder}/shot")) == 2
    schema = customer_analytics(spark.createDataFrame([], BRONZE["customers"]), RUN).schema
    assert [r["customer_count"] for r in read_snapshot(spark, f"{folder}/shot", schema).collect()] == [4]


def test_topic_messages_arrive_by_time_partition_and_offset(spark):
    rows = [(b'{"order_id": "x"}', 2, 7, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "value binary, partition int, offset long, timestamp string")
    (got,) = decode_json(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), "purchases").collect()
    assert got["order_id"] == "x" and tuple(got["arrival"])[1:] == (2, 7)


def test_medallion_and_analytics_jobs(spark, folder):
    times = [f"2024-01-01T00:{m:02d}:00" for m in range(6)]
    deliver(f"{folder}/clickstream", 0, [click("u", t) for t in times] + [click("u", times[0], None)])
    deliver(f"{folder}/purchases", 0, [purchase(f"o{i}", t) for i, t in enumerate(times)] + [purchase("z", times[0], 0)])
    deliver(f"{folder}/customers", 0, [{"customer_id": f"c{i}", "country": "fr", "email": "e" if i else None} for i in range(3)])
    streams = {e: arriving(spark, f"{folder}/{e}", e) for e in ENTITIES}
    queries = start_medallion(streams, f"{folder}/lake", f"{folder}/ckpt", ONCE_THROUGH)
    assert len(queries) == 9
    await_all(queries)

    def rows(layer, entity):
        return spark.read.parquet(f"{folder}/lake/{layer}/{entity}").count()

    assert {e: rows("bronze", e) for e in ENTITIES} == {"clickstream": 7, "purchases": 7, "customers": 3}
    assert {e: rows("silver", e) for e in ENTITIES} == {"clickstream": 6, "purchases": 6, "customers": 2}
    assert read_keyed(spark, f"{folder}/lake/keyed/clickstream", BRONZE["clickstream"], KEYS["clickstream"]).count() == 6

    streams = {e: df.drop("arrival") for e, df in streams.items()}
    await_all(start_analytics(streams, f"{folder}/lake", f"{folder}/ckpt", ONCE_THROUGH, "csv", run_ts=RUN))
    clicks = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/lake/clickstream_analytics")
    # Four closed minutes, the first of them with a second group for the event of no type.
    assert clicks.count() == 5 and {"window_start", "window_end", "engagement_score"} <= set(clicks.columns)
    schema = customer_analytics(spark.createDataFrame([], BRONZE["customers"]), RUN).schema
    snapshot = read_snapshot(spark, f"{folder}/lake/customer_analytics", schema).collect()
    assert [(r["country"], r["customer_count"], r["snapshot_date"]) for r in snapshot] == [("fr", 3, "2026-01-01")]


def test_await_all_raises_a_failure(spark, folder):
    deliver(f"{folder}/in", 0, [purchase("a", "2024-01-01T00:00:10")])

    def broken(batch, batch_id):
        raise ValueError("broken sink")

    source = stream(spark, f"{folder}/in", "purchases")
    bad = source.writeStream.foreachBatch(broken).option("checkpointLocation", f"{folder}/bad").start()
    good = stream_to_files(source, f"{folder}/out", f"{folder}/good")
    with pytest.raises(StreamingQueryException):
        await_all([good, bad])
    assert not good.isActive


def test_bronze_append_takes_each_file_once(spark, folder):
    def land(n):
        for entity in ENTITIES:
            os.makedirs(f"{folder}/in/{entity}", exist_ok=True)
            with open(f"{folder}/in/{entity}/{n}.csv", "w") as f:
                f.write(",".join(WIRE[entity].names) + "\n" + ",".join("1" for _ in WIRE[entity]) + "\n")

    for n in range(2):
        land(n)
        for _ in range(2):
            jobs.load_bronze_new(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/ckpt")
        assert spark.read.parquet(f"{folder}/bronze/purchases").count() == n + 1


def test_keyed_stream_equals_batch_upsert(spark, folder):
    deliver(f"{folder}/in", 0, [click(f"u{i % 3}", f"2024-01-01T00:00:0{i % 5}", session=f"s{i}") for i in range(30)])
    keys, schema = KEYS["clickstream"], BRONZE["clickstream"]
    source = stream(spark, f"{folder}/in", "clickstream")
    await_all([stream_upsert(source, keys, ["session_id"], f"{folder}/keyed", f"{folder}/ckpt", ONCE_THROUGH)])
    got = read_keyed(spark, f"{folder}/keyed", schema, keys)
    want = upsert(decode_json(spark.read.text(f"{folder}/in"), "clickstream"), keys, ["session_id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
