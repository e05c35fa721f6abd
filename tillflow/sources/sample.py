"""The three retail feeds, derived from the given tables.

Every row of the source tables is used.  Dirt is planted by key arithmetic so
that each cleaning rule has records to reject: blank and null ids, times that
are none, zero, unknown and negative numbers, malformed addresses.  Customer
``1`` is given a third of all purchases, so every plan meets a hot key; some
customers buy a few times only, some never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import WIRE
from tillflow.session import steps_of
from tillflow.sinks.folders import names

Tables = dict[str, DataFrame]


def given(spark: SparkSession, sf_dir: str, *names: str) -> Tables:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def clickstream_from(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    renamed = (
        F.when(F.col("event_type") == "view", " page_view")
        .when(F.col("event_type") == "signup", "add_to_cart ")
        .when(F.col("event_type") == "error", "scroll")
        .otherwise(F.col("event_type"))
    )
    return events.select(
        F.when(_every("event_id", 71), " ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(_every("event_id", 59), "bad-ts").otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.concat(F.lit(" https://shop.example.com/p/"), k, F.lit(" ")).alias("page_url"),
        F.when(~_every("event_id", 61), renamed).alias("event_type"),
        (F.lit(1000) + k.cast("int")).alias("product_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("session_id"),
        "event_id",
    )


def purchases_from(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    sold = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    few = (F.col("l_linenumber") == 7) & (F.col("l_quantity") <= 12)
    buyer = (
        F.when(_every("o_custkey", 3), "1")
        .when(_every("o_custkey", 5) & ~few, "guest")
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return sold.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        buyer.alias("user_id"),
        F.when(~_every("l_orderkey", 83), F.col("o_orderdate").cast("string")).alias("timestamp"),
        F.col("l_partkey").cast("int").alias("product_id"),
        F.when(_every("l_partkey", 89), 0)
        .when(~_every("l_partkey", 97), F.col("l_quantity").cast("int"))
        .alias("quantity"),
        F.when(_every("l_suppkey", 47), -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).alias("price"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("arrival"),
    )


def customers_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    address = F.concat(
        F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), F.col("c_mktsegment"),
        F.lit(".Example.COM "),
    )
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.when(_every("c_custkey", 101), "  ")
        .otherwise(F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")))
        .alias("name"),
        F.when(_every("c_custkey", 53), None)
        .when(_every("c_custkey", 41), "not-an-email")
        .when(_every("c_custkey", 37), "a@b.museums")
        .otherwise(address)
        .alias("email"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
        F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).cast("string").alias("signup_date"),
    )


FEEDS = {
    "clickstream": (clickstream_from, ("events",)),
    "purchases": (purchases_from, ("lineitem", "orders", "part")),
    "customers": (customers_from, ("customer", "nation")),
}


# Tables that are joined by a large shuffle, and the key by which steps take them.
STEP_KEYS = {"purchases": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}


def feed(spark: SparkSession, sf_dir: str, entity: str, step: tuple[int, int] = (0, 1)) -> DataFrame:
    """All records, or those of step ``i`` of ``n``."""
    derive, names = FEEDS[entity]
    found, (i, n) = given(spark, sf_dir, *names), step
    if n > 1:
        found |= {t: found[t].where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for t, key in STEP_KEYS[entity].items()}
    return derive(*found.values())


# A message's place in its topic: (timestamp, partition, offset), from columns that the wire format lacks.
PLACES = {
    "clickstream": ("timestamp '2024-01-01'", "0", "event_id"),
    # supplier, and price in cents, which has fewer than ten digits
    "purchases": (
        "cast(arrival.l_shipdate as timestamp)", "arrival.l_partkey", "arrival.l_suppkey * 10000000000 + round(arrival.l_extendedprice * 100)"
    ),
    "customers": ("timestamp '2024-01-01'", "0", "customer_id"),
}
MESSAGES = "value binary, timestamp timestamp, partition int, offset bigint"


def messages(spark: SparkSession, sf_dir: str, entity: str, step: tuple[int, int] = (0, 1), **more: Column) -> DataFrame:
    """The feed, or a step of it, as JSON messages of a topic, and the time of each record (``at``).

    Event types lose their padding and page urls too, as the live producer sends them clean.
    ``more`` are further columns, of the records' fields.
    """
    records = feed(spark, sf_dir, entity, step)
    if entity == "clickstream":
        records = records.withColumns({"event_type": F.trim("event_type"), "page_url": F.trim("page_url")})
    time, partition, offset = map(F.expr, PLACES[entity])
    return records.select(
        F.encode(F.to_json(F.struct(*WIRE[entity].names)), "UTF-8").alias("value"), time.alias("timestamp"),
        partition.cast("int").alias("partition"), offset.cast("long").alias("offset"), F.try_to_timestamp("signup_date" if entity == "customers" else "timestamp").alias("at"),
        *[column.alias(name) for name, column in more.items()],
    )


def message_steps(spark: SparkSession, sf_dir: str, entity: str, **more: Column) -> list[DataFrame]:
    """The messages in parts that are shuffled one at a time."""
    rows = [spark.read.parquet(f"{sf_dir}/{table}.parquet").count() for table in STEP_KEYS.get(entity, ())]
    count = steps_of(max(rows, default=0))
    return [messages(spark, sf_dir, entity, (i, count), **more) for i in range(count)]


def write_deliveries(found: DataFrame, path: str, count: int, last: str | None = None, steps: list[DataFrame] | None = None) -> list[str]:
    """Messages in ``count`` folders, in the order of their records' times; returns the folders that have any.

    Slices of equal length, so that records of equal times stay together; records without time come first.
    Messages whose column ``last`` is true come in one more folder after all others; those where it is null don't come.
    ``steps`` are parts of ``found``, written one after the other.
    """
    if count == 1 and not last:
        rows = 0
        for part in steps or [found]:
            seen = Observation()
            part = part.drop("at").observe(seen, F.count(F.lit(1)).alias("rows"))
            part.write.mode("append").option("compression", "zstd").parquet(f"{path}/delivery=0")
            rows += seen.get["rows"]
        return [f"{path}/delivery=0"] if rows else []
    timed = found.where(~F.col(last)) if last else found
    low, high = timed.agg(F.min("at").cast("double"), F.max("at").cast("double")).first()
    span = max((high or 0.0) - (low or 0.0), 1e-6)
    number = F.coalesce(F.floor((F.col("at").cast("double") - F.lit(low)) / span * count), F.lit(0))
    number = F.least(number, F.lit(count - 1))
    if last:
        number = F.when(F.col(last), count).when(~F.col(last), number)
    for part in steps or [found]:
        part = part.withColumn("delivery", number.cast("int")).where("delivery IS NOT NULL").drop("at", *([last] if last else []))
        part.write.mode("append").option("compression", "zstd").partitionBy("delivery").parquet(path)
    present = {name for name in names(found.sparkSession, path) if name.startswith("delivery=")}
    return [f"{path}/delivery={i}" for i in range(count + bool(last)) if f"delivery={i}" in present]


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The messages that have been delivered to a folder, as a stream."""
    return spark.readStream.schema(MESSAGES).parquet(f"{folder}/*")
