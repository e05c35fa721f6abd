"""Windowed measures of a stream whose closed windows never become state.

Spark's own aggregate puts every window of a batch into the state store, one
row at a time, logs it to the checkpoint, and takes it out again as soon as the
watermark has passed.  Here a window that closes within the batch that brought
it is measured from its rows as in a batch query; only the rows of windows that
are still open are kept, next to the checkpoint, for the batch after.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.analytics import LATENESS, flatten_window
from tillflow.session import steps_of
from tillflow.sinks import folders
from tillflow.streaming.late import committed_watermark, has_ended, window_start
from tillflow.streaming.sinks import batch_folder, held, started, write_steps


def in_steps(rows: DataFrame, time: str, count: int) -> list[DataFrame]:
    """The rows in ``count`` parts by time, about equally large; those of a window stay together."""
    if count == 1:
        return [rows]
    shares = [i / count for i in range(1, count)]
    found = rows.agg(F.percentile_approx(window_start(time), shares, 1000)).first()[0] or []
    cuts = [F.timestamp_micros(F.lit(c)) for c in sorted(set(found))]
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = rows if low is None else rows.where(F.col(time) >= low)
        parts.append(part if high is None else part.where(F.col(time) < high))
    return parts


def start_windows(
    df: DataFrame, time: str, measure: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: str | None = None,
    fmt: str = "parquet", name: str | None = None, lateness: str = LATENESS,
) -> StreamingQuery:
    """Appends the windows of ``measure``, each once, when the watermark has passed its end.

    The watermark is Spark's: ``lateness`` behind the latest time of all batches.
    A batch closes the windows that the watermark after it has passed, the one
    that the next batch is started with; a row whose window ended at the
    watermark its batch was started with is late and dropped, as are rows
    without time.  A batch that runs again reads the same open rows, so those of
    one batch before stay until then.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, watermark = batch.sparkSession, committed_watermark(batch.sparkSession, checkpoint, batch_id)
        work, still_open = f"{checkpoint}/held/{batch_id}", lambda i: f"{checkpoint}/open/{i}"
        newest = F.unix_millis(F.max(time) - F.expr(f"INTERVAL {lateness}"))
        rows, seen = held(batch.where(F.col(time).isNotNull() & ~has_ended(time, watermark)), work, newest=newest)
        if batch_id:
            if not folders.exists(spark, still_open(batch_id - 1)):
                raise RuntimeError(f"{checkpoint} holds no open windows of batch {batch_id - 1}: it belongs to another kind of query")
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(still_open(batch_id - 1)))
        closing = max(watermark, seen["newest"] if seen["newest"] is not None else watermark)
        closed = in_steps(rows.where(has_ended(time, closing)), time, steps_of(rows.count()))
        write_steps([flatten_window(measure(part)) for part in closed], batch_folder(batch, path, batch_id), fmt)
        rows.where(~has_ended(time, closing)).write.mode("overwrite").option("compression", "zstd").parquet(still_open(batch_id))
        folders.remove(spark, work)
        if batch_id > 1:
            folders.remove(spark, still_open(batch_id - 2))

    return started(df.withWatermark(time, lateness), write, checkpoint, trigger, name)
