"""Rows that come too late, kept apart instead of dropped.

A windowed aggregate drops a row whose window has been closed by the watermark
committed before the row's batch.  Spark writes that watermark into the
checkpoint, in the offset log's entry of the batch, before the batch runs; it is
read from there, so a batch that runs again is split the same way.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.analytics import LATENESS
from tillflow.streaming.sinks import batch_folder, started

# Fixed value: length of the windows that the watermark closes.
WINDOW_SECONDS = 60


def committed_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds of the watermark that a batch was started with; 0 before any event time is known.

    The entry's second line holds the batch's metadata.
    """
    lines = [row.value for row in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect()]
    found = [json.loads(line) for line in lines if line.startswith("{") and '"batchWatermarkMs"' in line]
    return int(found[0]["batchWatermarkMs"]) if found else 0


def window_start(time: str, window_seconds: int = WINDOW_SECONDS) -> Column:
    """Microseconds of the start of a row's window."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return micros - F.pmod(micros, F.lit(window_seconds * 1_000_000))


def has_ended(time: str, watermark_ms: int, window_seconds: int = WINDOW_SECONDS) -> Column:
    """Whether a row's window ends at the watermark or before; that of a row without time does not."""
    return F.coalesce(window_start(time, window_seconds) + window_seconds * 1_000_000 <= F.lit(watermark_ms * 1000), F.lit(False))


def is_late(time: str, watermark_ms: int, window_seconds: int = WINDOW_SECONDS) -> Column:
    """Whether a row's window had ended at the watermark; a row without time is not late."""
    return has_ended(time, watermark_ms, window_seconds) if watermark_ms else F.lit(False)


def start_split(
    df: DataFrame, time: str, path: str, late_path: str, checkpoint: str, trigger: str | None = None, name: str | None = None,
    lateness: str = LATENESS,
) -> StreamingQuery:
    """Appends rows in time to the store at ``path`` and late ones, with the watermark they missed, to that at ``late_path``.

    Both are written by every batch, into folders of the batch's own, so on-time
    and late rows together are all that was delivered, once each.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        watermark = committed_watermark(batch.sparkSession, checkpoint, batch_id)
        marked = batch.withColumn("__late", is_late(time, watermark))
        late = marked.where("__late").drop("__late").withColumn("missed_watermark", F.timestamp_millis(F.lit(watermark)))
        for rows, store in ((marked.where("NOT __late").drop("__late"), path), (late, late_path)):
            rows.write.mode("overwrite").parquet(batch_folder(batch, store, batch_id))

    return started(df.withWatermark(time, lateness), write, checkpoint, trigger, name)
