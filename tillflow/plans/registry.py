"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.scoring import engagement_score
from tillflow.operators import analytics, cleaning, gold, keyed, monitoring, quality, reports, sketches
from tillflow.operators.skew import sliced_join
from tillflow.operators.staging import STAGING, register_staging
from tillflow.plans import incremental, jobs
from tillflow.schemas import BRONZE, ENTITIES, KEYS, WIRE
from tillflow.session import scratch_path, streaming_session, use_utc
from tillflow.sinks import folders
from tillflow.sinks.curve import files_to_read
from tillflow.sinks.tables import GOLD_TABLES, export_gold, export_manifest, write_csv, write_table
from tillflow.sources.files import SourceMissing, csv_columns, find_silver, read_entity_csv, read_silver, require_sources, stored_tables, table
from tillflow.sources.messages import decode_checked, decode_json
from tillflow.sources.sample import feed, message_steps, message_stream, messages, write_deliveries
from tillflow.streaming.jobs import await_all, ingest_bronze_append, start_analytics, start_layers, start_medallion, start_quarantine
from tillflow.streaming.dedupe import start_deduped
from tillflow.streaming.late import start_split
from tillflow.streaming.progress import BatchLog
from tillflow.streaming.sinks import (
    ONCE_THROUGH,
    committed_batches,
    compact_keyed,
    read_batches,
    read_committed,
    read_keyed,
    read_snapshot,
    stream_snapshot,
    stream_to_files,
    stream_upsert,
)
from tillflow.streaming.windows import start_windows

Query = Callable[[SparkSession, str], DataFrame]

# One fixed run time for all registered queries, so that their stamps can be compared.
RUN_TS = "2026-01-01 00:00:00"
# Retention and freshness are measured from days inside the given data.
PURCHASES_AS_OF, CLICKS_AS_OF = "1998-01-08 00:00:00", "2024-02-01 00:00:00"
CLICKS_KEPT_AS_OF = "2024-01-25 09:30:00"


# One value for each attribute a silver table can be looked up by.
LOOKUPS = {
    ("customers", "email_domain"): "machinery.example.com",
    ("customers", "country"): "NATION_7",
    ("customers", "signup_year"): 1994,
    ("purchases", "user_id"): "1",
    ("purchases", "product_id"): 42,
    ("purchases", "purchase_year"): 1997,
    ("purchases", "purchase_month"): 3,
    ("clickstream", "event_type"): "ADD_TO_CART",
    ("clickstream", "product_id"): 1042,
    ("clickstream", "session_id"): "7-2024-01-05",
    ("clickstream", "event_year"): 2024,
    ("clickstream", "event_month"): 1,
}
# Tables to look up in have about so many files here; at full size a file holds millions of rows.
LOOKUP_FILES = 256


class Models:
    """The medallion layers over one data folder, each a lazy plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def raw(self, entity: str) -> DataFrame:
        return feed(self.spark, self.sf_dir, entity).select(*WIRE[entity].names)

    def bronze(self, entity: str) -> DataFrame:
        """The decoded records the live feed would deliver, as a batch."""
        df = self.raw(entity)
        if entity == "clickstream":
            df = df.withColumns({"event_type": F.trim("event_type"), "page_url": F.trim("page_url")})
        time = "signup_date" if entity == "customers" else "timestamp"
        return df.withColumn(time, F.try_to_timestamp(time))

    def silver(self, entity: str) -> DataFrame:
        return cleaning.silver(entity, self.raw(entity), RUN_TS)

    def stg(self, entity: str) -> DataFrame:
        return STAGING[entity](self.silver(entity), RUN_TS)

    def stored(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def stored_silver(self, fmt: str = "parquet", entities: tuple[str, ...] = ENTITIES) -> str:
        root = self.stored("silver")
        for entity in entities:
            write_table(self.silver(entity), f"{root}/{entity}", fmt)
        return root

    def stored_gold(self, entities: tuple[str, ...] = ("purchases", "customers")) -> dict[str, DataFrame]:
        root = self.stored_silver(entities=entities)
        return jobs.run_gold(self.spark, root, self.stored("gold"), RUN_TS, entities=entities)

    def rollup(self) -> DataFrame:
        return gold.customer_rollup(self.stg("purchases"))

    def dim(self) -> DataFrame:
        return gold.dim_customers(self.stg("customers"), self.stg("purchases"))

    def fct(self) -> DataFrame:
        return gold.fct_purchases(self.stg("purchases"), self.dim())

    def daily(self) -> DataFrame:
        return gold.daily_sales_summary(self.fct(), RUN_TS)


def _over(build: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Models(spark, sf_dir))


# Messages come in so many deliveries, each read by a run of its own.
DELIVERIES = 4


def _delivered(m: Models, entity: str, start, found: DataFrame | None = None, count: int = DELIVERIES) -> None:
    """Delivers the messages slice by slice and runs the query of ``start`` after each until it has read all."""
    session, source = streaming_session(m.spark), m.stored("messages")
    steps = message_steps(session, m.sf_dir, entity) if found is None else [found]
    slices = write_deliveries(messages(session, m.sf_dir, entity) if found is None else found, m.stored("slices"), count, steps=steps)
    for i, folder in enumerate(slices):
        folders.move(m.spark, folder, f"{source}/{i:04d}")
        await_all([start(decode_json(message_stream(session, source), entity))])


def _streamed(m: Models, entity: str, start, schema, **delivery) -> DataFrame:
    """What a query that appends to files has written of all deliveries."""
    out, checkpoint = m.stored("stream"), m.stored("checkpoint")
    _delivered(m, entity, lambda df: start(df, out, checkpoint), **delivery)
    return read_batches(m.spark, out, schema)


def _stream_windows(m: Models, entity: str, measure, distinct: str | None = None, **delivery) -> DataFrame:
    options = {"distinct": distinct} if distinct else {}
    expected = analytics.flatten_window(measure(m.bronze(entity), RUN_TS, **options))
    return _streamed(
        m, entity,
        lambda df, out, ckpt: stream_to_files(measure(df, RUN_TS, **options), out, ckpt, ONCE_THROUGH),
        expected.schema, **delivery,
    )


def _late_rows(m: Models) -> DataFrame:
    """Purchases per window; the third line of every order comes after everything else, mostly too late."""
    session, source = streaming_session(m.spark), m.stored("messages")
    late = F.col("order_id").endswith("-3")
    found, steps = (f(session, m.sf_dir, "purchases", late=late) for f in (messages, message_steps))
    out, checkpoint = m.stored("stream"), m.stored("checkpoint")
    measure = lambda rows: analytics.purchase_analytics(rows, RUN_TS)
    for i, folder in enumerate(write_deliveries(found, m.stored("slices"), DELIVERIES, "late", steps)):
        folders.move(m.spark, folder, f"{source}/{i:04d}")
        rows = decode_json(message_stream(session, source), "purchases").select(BRONZE["purchases"].names)
        await_all([start_windows(rows, "timestamp", measure, out, checkpoint, ONCE_THROUGH)])
    schema = analytics.flatten_window(analytics.purchase_analytics(m.bronze("purchases"), RUN_TS)).schema
    return read_batches(m.spark, out, schema)


def _approx_bound(m: Models) -> DataFrame:
    """Per window: whether the sketched distinct counts are within a tenth, or one, of the exact ones."""
    keys = ["window_start", "page_url", "event_type"]
    sketched = _stream_windows(m, "clickstream", analytics.clickstream_analytics, "approx")
    exact = analytics.flatten_window(analytics.clickstream_analytics(m.bronze("clickstream"), RUN_TS))
    exact = exact.select(*keys, F.col("unique_users").alias("users"), F.col("unique_sessions").alias("sessions"))
    both = sketched.alias("s").join(exact.alias("e"), [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys])
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1), F.col(b) / 10)
    return both.select(*[f"s.{k}" for k in keys], "event_count", (near("unique_users", "users") & near("unique_sessions", "sessions")).alias("within_bound"))


def _stream_layer(m: Models, entity: str, silver: bool) -> DataFrame:
    def start(df: DataFrame, out: str, checkpoint: str):
        df = df.select(BRONZE[entity].names)
        return stream_to_files(cleaning.stream_filter(entity, df) if silver else df, out, checkpoint, ONCE_THROUGH)

    return _streamed(m, entity, start, BRONZE[entity], count=2)


def _stream_restart(m: Models) -> DataFrame:
    """Bronze customers after a second run on the same checkpoint, which finds nothing new."""
    out, checkpoint = m.stored("stream"), m.stored("checkpoint")

    def twice(df: DataFrame):
        start = lambda: stream_to_files(df.select(BRONZE["customers"].names), out, checkpoint, ONCE_THROUGH)
        await_all([start()])
        return start()

    _delivered(m, "customers", twice, count=2)
    return read_batches(m.spark, out, BRONZE["customers"])


def _upserted(m: Models, entity: str, after=None) -> DataFrame:
    out, checkpoint, names = m.stored("keyed"), m.stored("checkpoint"), BRONZE[entity].names

    def start(df: DataFrame):
        if after and folders.exists(m.spark, out):
            after(out)
        return stream_upsert(df, KEYS[entity], ["arrival"], out, checkpoint, ONCE_THROUGH, columns=names)

    # one delivery by time would split the copies of a key as they arrive, so slices follow the arrival
    found = messages(m.spark, m.sf_dir, entity)
    _delivered(m, entity, start, found.withColumn("at", F.timestamp_micros("offset")) if entity == "clickstream" else found)
    return read_keyed(m.spark, out, BRONZE[entity], KEYS[entity])


def _compacted(m: Models) -> DataFrame:
    """The keyed table, folded before each delivery but the first."""
    fold = lambda out: compact_keyed(m.spark, out, BRONZE["clickstream"], KEYS["clickstream"])
    return _upserted(m, "clickstream", fold)


def _layers(m: Models, entity: str, root: str) -> dict[str, DataFrame]:
    schema = BRONZE[entity]
    found = {layer: read_batches(m.spark, f"{root}/{layer}/{entity}", schema) for layer in ("bronze", "silver")}
    return found | {"keyed": read_keyed(m.spark, f"{root}/keyed/{entity}", schema, KEYS[entity])}


def _stream_layers(m: Models) -> dict[str, DataFrame]:
    """All three copies of the purchases, written from one read of the stream."""
    root, checkpoint = m.stored("layers"), m.stored("checkpoint")
    _delivered(m, "purchases", lambda df: start_layers("purchases", df, root, checkpoint, trigger=ONCE_THROUGH), count=1)
    return _layers(m, "purchases", root)


def _stream_committed(m: Models) -> DataFrame:
    """All three copies of the purchases after two deliveries, while a third batch has written its first copy only."""
    root, checkpoint, schema = m.stored("layers"), m.stored("checkpoint"), BRONZE["purchases"]
    _delivered(m, "purchases", lambda df: start_layers("purchases", df, root, checkpoint, trigger=ONCE_THROUGH), count=2)
    *_, last = committed_batches(m.spark, root, "bronze", "purchases")
    in_flight = f"{last.rpartition('=')[0]}={int(last.rpartition('=')[2]) + 1}"
    write_table(m.spark.read.schema(schema).parquet(last), in_flight)
    layers = {
        layer: read_committed(m.spark, root, layer, "purchases", schema, KEYS["purchases"] if layer == "keyed" else None)
        for layer in ("bronze", "keyed", "silver")
    }
    return quality.union_all([df.withColumn("layer", F.lit(layer)) for layer, df in layers.items()])


def _late_split(m: Models) -> DataFrame:
    """Purchases in two stores: those in time, and the third lines of orders, which come last and mostly too late."""
    found = messages(m.spark, m.sf_dir, "purchases")
    late = F.get_json_object(F.decode("value", "UTF-8"), "$.order_id").endswith("-3")
    path, late_path, checkpoint = m.stored("in_time"), m.stored("late_rows"), m.stored("checkpoint")
    session, source = streaming_session(m.spark), m.stored("messages")
    slices = write_deliveries(found.where(~late), m.stored("slices"), DELIVERIES) + write_deliveries(found.where(late), m.stored("late"), 1)
    for i, folder in enumerate(slices):
        folders.move(m.spark, folder, f"{source}/{i:04d}")
        rows = decode_json(message_stream(session, source), "purchases").select(BRONZE["purchases"].names)
        await_all([start_split(rows, "timestamp", path, late_path, checkpoint, ONCE_THROUGH)])
    stores = [read_batches(m.spark, p, BRONZE["purchases"]).withColumn("late", F.lit(p == late_path)) for p in (path, late_path)]
    return stores[0].unionByName(stores[1])


def _stream_deduped(m: Models) -> DataFrame:
    """Clicks of which every message comes twice, and all of the first deliveries once more with the last."""
    found = messages(m.spark, m.sf_dir, "clickstream").where("at IS NOT NULL")
    names, out, checkpoint = BRONZE["clickstream"].names, m.stored("stream"), m.stored("checkpoint")
    session, source = streaming_session(m.spark), m.stored("messages")
    slices = write_deliveries(found.unionByName(found), m.stored("slices"), DELIVERIES)
    again = m.stored("again")
    write_table(quality.union_all([m.spark.read.parquet(s) for s in slices[:-1]]), again)
    for i, folder in enumerate([*slices, again]):
        folders.move(m.spark, folder, f"{source}/{i:04d}")
        rows = decode_json(message_stream(session, source), "clickstream").select(names)
        await_all([start_deduped(rows, names, "timestamp", out, checkpoint, ONCE_THROUGH)])
    return read_batches(m.spark, out, BRONZE["clickstream"])


def _broken_messages(m: Models) -> DataFrame:
    """Purchases' messages, of which every 11th is cut off, every 13th has text for a quantity and every 17th is empty."""
    purchases = feed(m.spark, m.sf_dir, "purchases").withColumn("n", F.split_part("order_id", F.lit("-"), F.lit(1)).cast("bigint"))
    good = F.to_json(F.struct(*WIRE["purchases"].names))
    cut = F.concat(F.lit('{"order_id":"'), "order_id")
    unfit = F.concat(F.lit('{"order_id":"'), "order_id", F.lit('","quantity":"many"}'))
    text = F.when(F.col("n") % 11 == 0, cut).when(F.col("n") % 13 == 0, unfit).when(F.col("n") % 17 == 0, F.lit(None)).otherwise(good)
    return purchases.select(F.encode(text, "UTF-8").alias("value"), F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("partition"), F.col("n").alias("offset"), F.try_to_timestamp("timestamp").alias("at"))


def _stream_quarantine(m: Models) -> DataFrame:
    """Messages that can't be read, with their text, and records that fail a rule."""
    session, source, root, checkpoints = streaming_session(m.spark), m.stored("messages"), m.stored("lake"), m.stored("checkpoints")
    for i, folder in enumerate(write_deliveries(_broken_messages(m), m.stored("slices"), 2)):
        folders.move(m.spark, folder, f"{source}/{i:04d}")
        await_all([start_quarantine("purchases", message_stream(session, source), root, checkpoints, ONCE_THROUGH)])
    expected = cleaning.message_quarantine("purchases", decode_checked(_broken_messages(m), "purchases"))
    return read_batches(m.spark, f"{root}/quarantine/purchases", expected.schema)


def _stream_batches(m: Models) -> DataFrame:
    """Rows of each batch with any, as a listener saw them."""
    log, out, checkpoint = BatchLog(), m.stored("stream"), m.stored("checkpoint")
    session = streaming_session(m.spark)
    log.attach(session)
    source, names = m.stored("messages"), BRONZE["clickstream"].names
    slices = write_deliveries(messages(m.spark, m.sf_dir, "clickstream"), m.stored("slices"), DELIVERIES)
    try:
        for i, folder in enumerate(slices):
            folders.move(m.spark, folder, f"{source}/{i:04d}")
            rows = decode_json(message_stream(session, source), "clickstream").select(names)
            await_all([stream_to_files(rows, out, checkpoint, ONCE_THROUGH, name="clicks")])
        session._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        return log.table(m.spark).where("rows > 0").select("query", "batch", "rows")
    finally:
        log.detach(session)


def _sketch_bound(m: Models) -> DataFrame:
    """Per hour and day: whether counts from united sketches of minutes are within a tenth, or one, of the exact ones."""
    path, events = m.stored("sketches"), m.bronze("clickstream")
    write_table(analytics.flatten_window(sketches.click_sketches(events)), path)
    stored, found = m.spark.read.parquet(path), []
    for grain in ("hour", "day"):
        keys = [F.date_trunc(grain, "timestamp").alias("start"), "page_url", "event_type"]
        exact = events.where("timestamp IS NOT NULL").groupBy(*keys).agg(F.countDistinct("user_id").alias("users"), F.countDistinct("session_id").alias("sessions"))
        both = sketches.rolled_up(stored, grain).alias("s").join(exact.alias("e"), [F.col(f"s.{k}").eqNullSafe(F.col(f"e.{k}")) for k in ("start", "page_url", "event_type")])
        near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1), F.col(b) / 10)
        found.append(both.select(F.lit(grain).alias("grain"), "s.start", "s.page_url", "s.event_type", "event_count", (near("unique_users", "users") & near("unique_sessions", "sessions")).alias("within_bound")))
    return quality.union_all(found)


def _daily_incremental(m: Models) -> DataFrame:
    """The daily summary after three deliveries, of which the last brings late purchases and new customers."""
    root, staged, customers = m.stored("incremental"), m.stored("staged"), m.stg("customers")
    n = F.pmod(F.crc32("order_id"), F.lit(50))
    number = F.when(F.col("purchase_date") >= F.lit("1998-01-01").cast("date"), 2).when(n == 0, 3).otherwise(1)
    write_table(m.stg("purchases").withColumn("delivery", number), staged)
    rows, late_customer = m.spark.read.parquet(staged), F.pmod(F.crc32("customer_id"), F.lit(20)) == 0
    for i in (1, 2, 3):
        known = customers if i == 3 else customers.where(~late_customer)
        incremental.delivered(m.spark, root, i, rows.where(F.col("delivery") == i).drop("delivery"), known, RUN_TS)
    return incremental.read_summary(m.spark, root, m.daily())


def _new_checkpoint(m: Models) -> DataFrame:
    """All three copies of the customers, half of them written on one checkpoint and half on another."""
    root, checkpoints = m.stored("layers"), iter([m.stored("checkpoint"), m.stored("checkpoint")])
    halves = write_deliveries(messages(m.spark, m.sf_dir, "customers"), m.stored("slices"), 2)
    for folder, checkpoint in zip(halves, checkpoints):
        source = m.stored("messages")
        folders.move(m.spark, folder, f"{source}/0")
        stream = decode_json(message_stream(streaming_session(m.spark), source), "customers")
        await_all([start_layers("customers", stream, root, checkpoint, trigger=ONCE_THROUGH)])
    return quality.union_all([df.withColumn("layer", F.lit(layer)) for layer, df in _layers(m, "customers", root).items()])


def _stream_countries(m: Models, checkpoints: int = 1) -> DataFrame:
    """The newest snapshot; with two checkpoints the second run starts from the earliest message again."""
    out = m.stored("snapshot")
    for _ in range(checkpoints):
        checkpoint = m.stored("checkpoint")
        start = lambda df, at=checkpoint: stream_snapshot(analytics.customer_analytics(df, RUN_TS), out, at, ONCE_THROUGH)
        _delivered(m, "customers", start)
    return read_snapshot(m.spark, out, analytics.customer_analytics(m.bronze("customers"), RUN_TS).schema)


def _all_streams(m: Models) -> dict[str, DataFrame]:
    session, streams = streaming_session(m.spark), {}
    for entity in ENTITIES:
        source = m.stored("messages")
        found, steps = (f(session, m.sf_dir, entity) for f in (messages, message_steps))
        (folder,) = write_deliveries(found, m.stored("slices"), 1, steps=steps)
        folders.move(m.spark, folder, f"{source}/0")
        streams[entity] = decode_json(message_stream(session, source), entity)
    return streams


_job_roots: dict[tuple[str, str, str], str] = {}


def _job_root(m: Models, job: str, run: Callable[[str], None]) -> str:
    """Where a job has written all its outputs; it runs at the first query of an application that reads one of them."""
    name = (m.spark.sparkContext.applicationId, m.sf_dir, job)
    if name not in _job_roots:
        root = m.stored(job)
        run(root)
        _job_roots[name] = root
    return _job_roots[name]


def _medallion(m: Models, layer: str = "keyed", entity: str = "purchases") -> DataFrame:
    """One of the nine outputs of the job with nine queries."""
    run = lambda root: await_all(start_medallion(_all_streams(m), root, m.stored("checkpoints"), ONCE_THROUGH))
    return _layers(m, entity, _job_root(m, "medallion", run))[layer]


def _analytics_job(m: Models, output: str = "customers") -> DataFrame:
    """One of the three outputs of the job with three queries."""

    def run(root: str) -> None:
        records = {e: df.select(BRONZE[e].names) for e, df in _all_streams(m).items()}
        await_all(start_analytics(records, root, m.stored("checkpoints"), ONCE_THROUGH, run_ts=RUN_TS))

    root = _job_root(m, "analytics", run)
    if output == "customers":
        return read_snapshot(m.spark, f"{root}/customer_analytics", analytics.customer_analytics(m.bronze("customers"), RUN_TS).schema)
    measure, name = (
        (analytics.clickstream_analytics, "clickstream_analytics") if output == "clickstream" else (analytics.purchase_analytics, "purchase_analytics")
    )
    return read_batches(m.spark, f"{root}/{name}", _windows(m, output, measure).schema)


def _decoded(m: Models) -> DataFrame:
    messages = m.raw("purchases").select(F.encode(F.to_json(F.struct("*")), "UTF-8").alias("value"))
    return decode_json(messages, "purchases")


def _csv_round_trip(m: Models, mode: str) -> DataFrame:
    path = m.stored("purchases.csv")
    write_csv(m.raw("purchases"), path)
    return read_entity_csv(m.spark, "purchases", path, mode)


def _landing(m: Models) -> str:
    source = m.stored("landing")
    as_they_are = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for entity in ENTITIES:
        m.raw(entity).write.options(**as_they_are).csv(f"{source}/{entity}.csv")
    return source


def _bronze_full(m: Models) -> dict[str, DataFrame]:
    root = m.stored("bronze")
    jobs.load_bronze_full(m.spark, _landing(m), root)
    return {e: m.spark.read.schema(WIRE[e]).parquet(f"{root}/{e}") for e in ENTITIES}


def _bronze_append(m: Models) -> DataFrame:
    """Two deliveries, each followed by an ingest run; the second run takes the second only."""
    source, out, checkpoint = m.stored("landing"), m.stored("bronze"), m.stored("checkpoint")
    session = streaming_session(m.spark)
    for entity in ("customers", "customers"):
        m.raw(entity).write.mode("append").option("header", True).csv(source)
        await_all([ingest_bronze_append(session, entity, source, out, checkpoint, WIRE[entity])])
    return read_batches(m.spark, out, WIRE["customers"])


def _batch_silver(m: Models) -> tuple[DataFrame, str]:
    """Row counts as the job returns them, and where the tables are."""
    root = m.stored("silver")
    return jobs.run_batch_silver(m.spark, _landing(m), root, RUN_TS, by_date=True), root


def _keyed_load(m: Models) -> DataFrame:
    """Purchases from CSV files that hold them in the order in which they arrived."""
    source, root = m.stored("landing"), m.stored("keyed")
    ordered = feed(m.spark, m.sf_dir, "purchases").repartitionByRange("arrival").sortWithinPartitions("arrival")
    write_csv(ordered.select(WIRE["purchases"].names), f"{source}/purchases.csv")
    for entity in ("clickstream", "customers"):
        write_csv(m.raw(entity), f"{source}/{entity}.csv")
    jobs.load_keyed(m.spark, source, root)
    return m.spark.read.schema(BRONZE["purchases"]).parquet(f"{root}/purchases")


_lookup_roots: dict[tuple[str, str, str], str] = {}


def _lookup_table(m: Models, entity: str) -> DataFrame:
    """The table to look up in, written at the first look-up of an application and read by all."""
    name = (m.spark.sparkContext.applicationId, m.sf_dir, entity)
    if name not in _lookup_roots:
        root = m.stored("lookups")
        jobs.write_lookups(m.spark, m.stored_silver(entities=(entity,)), root, entity, LOOKUP_FILES)
        _lookup_roots[name] = root
    return read_silver(m.spark, _lookup_roots[name], entity)


def _looked_up(m: Models, entity: str, column: str, value) -> DataFrame:
    return reports.lookup(_lookup_table(m, entity), **{column: value})


def _lookup_files(m: Models) -> DataFrame:
    """Per attribute: the rows that a look-up finds, and whether it leaves at most half of the files to be read."""
    found = []
    for (entity, column), value in LOOKUPS.items():
        table = _lookup_table(m, entity)
        files = files_to_read(table, column, value).select("files", "read", F.lit(0).alias("records"), F.lit(0).alias("total"))
        rows = table.agg(F.count_if(F.col(column) == F.lit(value)).alias("records"), F.count("*").alias("total"))
        both = files.unionByName(rows.select(F.lit(0).alias("files"), F.lit(0).alias("read"), "records", "total")).agg(
            *[F.sum(c).alias(c) for c in ("files", "read", "records", "total")]
        )
        # no layout skips much for a value that a quarter of all rows hold
        skips = (2 * F.col("read") <= F.col("files")) | (4 * F.col("records") >= F.col("total"))
        found.append(both.select(F.lit(entity).alias("table"), F.lit(column).alias("column"), "records", skips.alias("skips_most")))
    return quality.union_all(found)


def _kept(m: Models) -> DataFrame:
    """A stored table after its old rows were removed."""
    path = m.stored("purchases")
    write_table(m.silver("purchases"), path)
    jobs.remove_old(m.spark, path, "timestamp", PURCHASES_AS_OF, 7)
    return m.spark.read.schema(m.silver("purchases").schema).parquet(path)


def _kept_folders(m: Models) -> DataFrame:
    """A table in folders by day after retention, and whether each row's file is one from before."""
    path, columns = m.stored("clickstream"), ["event_year", "event_month", "event_day"]
    write_table(m.silver("clickstream"), path, partition_by=columns)
    table = lambda: m.spark.read.schema(m.silver("clickstream").schema).parquet(path)
    before = m.stored("files")
    write_table(table().select(F.col("_metadata.file_path").alias("old_file")).distinct(), before)
    jobs.remove_old(m.spark, path, "timestamp", CLICKS_KEPT_AS_OF, 7, columns)
    now = table().withColumn("file", F.col("_metadata.file_path"))
    joined = now.join(m.spark.read.parquet(before), F.col("file") == F.col("old_file"), "left")
    return joined.withColumn("same_file", F.col("old_file").isNotNull()).drop("file", "old_file")


def _summary(m: Models) -> DataFrame:
    return jobs.batch_summary(m.spark, _landing(m), m.stored("silver"), RUN_TS)


def _stored_counts(m: Models) -> DataFrame:
    """Rows of the silver and gold tables, from the footers of their files."""
    silver, gold_root = m.stored_silver(), m.stored("gold")
    jobs.run_gold(m.spark, silver, gold_root, RUN_TS, entities=("purchases", "customers"))
    paths = {f"silver_{e}": f"{silver}/{e}" for e in ENTITIES} | {name: f"{gold_root}/{name}" for name in GOLD_TABLES}
    return quality.row_counts(stored_tables(m.spark, paths))


def _previewed(m: Models) -> DataFrame:
    """How many rows a preview gives, and whether the table has them all."""
    silver = m.silver("customers")
    known = silver.select("customer_id").distinct().withColumn("known", F.lit(1))
    return reports.preview(silver).join(known, "customer_id", "left").agg(F.count("*").alias("shown"), F.count("known").alias("known"))


def _header(m: Models) -> DataFrame:
    """The columns of a CSV file, from its header."""
    path = m.stored("customers.csv")
    write_csv(m.raw("customers"), path)
    return m.spark.createDataFrame(list(enumerate(csv_columns(m.spark, path), 1)), "position bigint, column string")


def _gate(m: Models) -> DataFrame:
    """What the source gate says when one of the three inputs is missing."""
    source = _landing(m)
    folders.remove(m.spark, f"{source}/customers.csv")
    try:
        require_sources(m.spark, {e: f"{source}/{e}.csv" for e in ENTITIES})
        missing = ""
    except SourceMissing as found:
        missing = str(found).split("(")[0].strip()
    return m.raw("customers").agg(F.lit(missing).alias("said"), F.count("*").alias("not_loaded"))


def _views(m: Models) -> DataFrame:
    """A staging view, read by its name."""
    root = m.stored_silver()
    models = jobs.staging_models(m.spark, root, RUN_TS)
    register_staging(m.spark, {name.removeprefix("stg_"): df for name, df in models.items()})
    return table(m.spark, "stg_customers")


def _silver_csv(m: Models) -> DataFrame:
    return STAGING["customers"](read_silver(m.spark, m.stored_silver("csv", ("customers",)), "customers", "csv"), RUN_TS)


def _gold_job(m: Models) -> DataFrame:
    return m.stored_gold()["daily_sales_summary"]


def _exported(m: Models, name: str) -> DataFrame:
    tables = m.stored_gold()
    folder = export_gold({name: tables[name] for name in GOLD_TABLES}, m.stored("export"), "run")
    return m.spark.read.schema(tables[name].schema).option("header", True).csv(f"{folder}/{name}")


def _manifest(m: Models) -> DataFrame:
    tables = m.stored_gold()
    return export_manifest({name: tables[name] for name in GOLD_TABLES}, RUN_TS)


def _purchase_log(m: Models) -> DataFrame:
    """Purchases as typed rows, with the place each has in the order of arrival."""
    df = feed(m.spark, m.sf_dir, "purchases")
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def _click_log(m: Models) -> DataFrame:
    df = feed(m.spark, m.sf_dir, "clickstream")
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp"))


def _customer_changes(m: Models) -> DataFrame:
    """Every customer delivered again from a country written in full capitals."""
    current = m.bronze("customers")
    return keyed.merge_latest(current, current.withColumn("country", F.upper(F.trim("country"))), KEYS["customers"], ["email"])


def _moved(m: Models) -> DataFrame:
    return keyed.upsert(_purchase_log(m), KEYS["purchases"], ["arrival"]).drop("arrival")


def _checks(m: Models) -> DataFrame:
    return jobs.run_checks(m.stored_gold())


def _all_counts(m: Models) -> DataFrame:
    return quality.row_counts(m.stored_gold(ENTITIES))


def _orphans(m: Models) -> DataFrame:
    tables = m.stored_gold()
    orphans = quality.orphaned_purchases(tables["fct_purchases"], tables["dim_customers"])
    return orphans.select("order_id", "customer_id", "total_amount")


def _reconciled(m: Models) -> DataFrame:
    tables = m.stored_gold()
    return quality.revenue_reconciliation(tables["daily_sales_summary"], tables["fct_purchases"])


def _presence(m: Models) -> DataFrame:
    return jobs.run_silver_checks(m.spark, m.stored_silver())


def _file_stats(m: Models) -> DataFrame:
    """File measures summed per table; names and sizes differ from one write to the next."""
    root = m.stored_silver()
    files = [quality.file_stats(read_silver(m.spark, root, e)).withColumn("table", F.lit(e)) for e in ENTITIES]
    return (
        quality.union_all(files)
        .groupBy("table")
        .agg(F.sum("records").alias("records"), F.bool_and(F.col("bytes") > 0).alias("all_sized"))
    )


def _processing_stats(m: Models) -> DataFrame:
    found = find_silver(m.spark, m.stored_silver())
    files = quality.union_all([quality.file_stats(df) for df in found.values()])
    stats = quality.processing_stats(quality.silver_presence(m.spark, found), files, RUN_TS)
    return stats.withColumn("total_bytes", F.col("total_bytes") > 0).withColumnRenamed("total_bytes", "has_bytes")


def _engagement(m: Models) -> DataFrame:
    counts = m.bronze("clickstream").groupBy("event_type").agg(F.count("*").alias("event_count"))
    return counts.withColumn("engagement_score", engagement_score(F.col("event_type"), F.col("event_count")))


def _windows(m: Models, entity: str, measure) -> DataFrame:
    return analytics.flatten_window(measure(m.bronze(entity), RUN_TS))


def _dq_metrics(m: Models) -> DataFrame:
    return quality.union_all([monitoring.dq_metrics(e, m.raw(e)) for e in ENTITIES])


def _conformance(m: Models) -> DataFrame:
    """Silver as it should be, and the raw feed, which lacks and has columns."""
    clean = {e: m.silver(e) for e in ENTITIES}
    raw = quality.schema_conformance({"purchases": m.raw("purchases")}).withColumn("table", F.lit("purchases (raw)"))
    return quality.schema_conformance(clean).unionByName(raw)


def _sliced(m: Models) -> DataFrame:
    """Purchases per country of the buyer; customer 1 is hot and dealt over many slices."""
    purchases, customers = m.stg("purchases"), m.stg("customers")
    joined = sliced_join(
        purchases.select("customer_id", "order_id"), customers.select("customer_id", "country"), "customer_id"
    )
    return joined.groupBy("country").agg(F.count("*").alias("purchases"))


def build() -> dict[str, Query]:
    found: dict[str, Callable[[Models], DataFrame]] = {}
    for entity in ENTITIES:
        found[f"feed_{entity}"] = lambda m, e=entity: m.raw(e)
        found[f"silver_{entity}"] = lambda m, e=entity: m.silver(e)
        found[f"quarantine_{entity}"] = lambda m, e=entity: cleaning.quarantine(e, m.raw(e))
        found[f"stream_filter_{entity}"] = lambda m, e=entity: cleaning.stream_filter(e, m.bronze(e))
        found[f"stg_{entity}"] = lambda m, e=entity: m.stg(e)
        found[f"stream_bronze_{entity}"] = lambda m, e=entity: _stream_layer(m, e, silver=False)
        found[f"stream_silver_{entity}"] = lambda m, e=entity: _stream_layer(m, e, silver=True)
        found[f"bronze_full_{entity}"] = lambda m, e=entity: _bronze_full(m)[e]
        found[f"batch_silver_{entity}"] = lambda m, e=entity: read_silver(m.spark, _batch_silver(m)[1], e)
        found[f"stream_analytics_job_{entity}"] = lambda m, e=entity: _analytics_job(m, e)
        for layer in ("bronze", "silver", "keyed"):
            found[f"stream_medallion_{layer}_{entity}"] = lambda m, name=layer, e=entity: _medallion(m, name, e)
    for layer in ("bronze", "silver", "keyed"):
        found[f"stream_layers_{layer}"] = lambda m, name=layer: _stream_layers(m)[name]
    found |= {
        "customer_rollup": Models.rollup,
        "dim_customers": Models.dim,
        "fct_purchases": Models.fct,
        "daily_sales_summary": Models.daily,
        "daily_sales_trend": lambda m: reports.daily_sales_trend(m.daily()),
        "top_days": lambda m: reports.top_days(m.daily()),
        "top_customers": lambda m: reports.top_customers(m.dim()),
        "recent_purchases": lambda m: reports.recent_purchases(m.fct()),
        "segment_distribution": lambda m: reports.segment_distribution(m.dim()),
        "product_performance": lambda m: reports.product_performance(m.stg("purchases")),
        "preview": lambda m: reports.preview(m.silver("purchases")),
        "sliced_join": _sliced,
        "orphaned_purchases": _orphans,
        "orphan_count": lambda m: quality.orphan_count(m.stg("purchases"), m.stg("customers")),
        "revenue_reconciliation": _reconciled,
        "date_consistency": lambda m: quality.date_consistency(m.fct()),
        "check_not_null": lambda m: quality.check_not_null(m.raw("purchases"), "order_id", "timestamp", "quantity", table="purchases"),
        "check_unique": lambda m: quality.check_unique(m.raw("purchases"), "order_id", "purchases"),
        "check_unique_after_upsert": lambda m: quality.check_unique(_moved(m), "order_id", "purchases"),
        "run_checks": _checks,
        "row_counts": _all_counts,
        "schema_conformance": _conformance,
        "silver_presence": _presence,
        "file_stats": _file_stats,
        "processing_stats": _processing_stats,
        "profile": lambda m: quality.profile(m.silver("customers"), "customers"),
        "retention": lambda m: keyed.apply_retention(m.silver("purchases"), "timestamp", PURCHASES_AS_OF, 7),
        "clickstream_analytics": lambda m: _windows(m, "clickstream", analytics.clickstream_analytics),
        "purchase_analytics": lambda m: _windows(m, "purchases", analytics.purchase_analytics),
        "customer_analytics": lambda m: analytics.customer_analytics(m.bronze("customers"), RUN_TS),
        "engagement_score": _engagement,
        "decode_json": _decoded,
        "csv_declared": lambda m: _csv_round_trip(m, "declared"),
        "csv_typed": lambda m: _csv_round_trip(m, "typed"),
        "csv_inferred": lambda m: _csv_round_trip(m, "inferred"),
        "silver_csv": _silver_csv,
        "bronze_full": lambda m: quality.row_counts(_bronze_full(m)),
        "bronze_append": lambda m: _bronze_append(m).groupBy("country").agg(F.count("*").alias("records")),
        "bronze_append_rows": _bronze_append,
        "batch_silver": lambda m: _batch_silver(m)[0],
        "keyed_load": _keyed_load,
        "retention_applied": _kept,
        "retention_partitioned": _kept_folders,
        "lookup_files": _lookup_files,
        "batch_summary": _summary,
        "daily_incremental": _daily_incremental,
        "sketch_rollup_bound": _sketch_bound,
        "stream_late_split": _late_split,
        "stream_quarantine": _stream_quarantine,
        "stream_layers_committed": _stream_committed,
        "stream_batches": _stream_batches,
        "stream_deduped": _stream_deduped,
        "stored_counts": _stored_counts,
        "validate": lambda m: jobs.validate(m.stored_gold())["checks"],
        "preview_check": _previewed,
        "csv_header": _header,
        "source_gate": _gate,
        "staging_views": _views,
        "gold_job": _gold_job,
        "export_gold": lambda m: _exported(m, "daily_sales_summary"),
        "export_dim_customers": lambda m: _exported(m, "dim_customers"),
        "export_fct_purchases": lambda m: _exported(m, "fct_purchases"),
        "export_manifest": _manifest,
        "stream_clickstream_analytics": lambda m: _stream_windows(m, "clickstream", analytics.clickstream_analytics, "exact"),
        "stream_clickstream_approx": lambda m: _stream_windows(m, "clickstream", analytics.clickstream_analytics, "approx"),
        "stream_purchase_analytics": lambda m: _stream_windows(m, "purchases", analytics.purchase_analytics),
        "stream_customer_analytics": _stream_countries,
        "stream_one_delivery": lambda m: _stream_windows(m, "purchases", analytics.purchase_analytics, count=1),
        "stream_late_rows": _late_rows,
        "stream_approx_bound": _approx_bound,
        "stream_restart": _stream_restart,
        "stream_new_checkpoint": _new_checkpoint,
        "stream_snapshot_new_checkpoint": lambda m: _stream_countries(m, 2),
        "stream_upsert": lambda m: _upserted(m, "clickstream"),
        "keyed_compacted": _compacted,
        "stream_layers": lambda m: quality.row_counts(_stream_layers(m)),
        "stream_medallion": _medallion,
        "stream_analytics_job": _analytics_job,
        "upsert_purchases": _moved,
        "upsert_clickstream": lambda m: keyed.upsert(_click_log(m), KEYS["clickstream"], ["event_id"]).drop("event_id"),
        "upsert_customers": _customer_changes,
        "dedupe_latest": lambda m: keyed.dedupe_latest(
            m.stg("purchases"), ["customer_id"],
            ["purchase_timestamp", "order_id", "product_id", "quantity", "unit_price"],
        ),
        "dq_metrics": _dq_metrics,
        "freshness": lambda m: monitoring.freshness(m.silver("clickstream"), "timestamp", CLICKS_AS_OF),
        "volume_daily": lambda m: monitoring.volume_daily(m.silver("clickstream"), "timestamp"),
    }
    for (entity, column), value in LOOKUPS.items():
        found[f"lookup_{entity}_{column}"] = lambda m, e=entity, c=column, v=value: _looked_up(m, e, c, v)
    return {name: _over(query) for name, query in found.items()}
