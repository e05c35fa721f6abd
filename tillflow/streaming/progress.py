"""What each batch of the running queries did, and whether their triggers hold."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = (
    "query string, run string, batch bigint, started timestamp, rows bigint, seconds double, watermark timestamp, "
    "state_rows bigint, dropped_rows bigint"
)


class BatchLog(StreamingQueryListener):
    """Collects a row per batch; ``keep`` batches of all queries at most, the oldest go first.

        log = BatchLog().attach(spark)
        ...
        log.table(spark).show()

    Progress comes from another thread, some time after the batch.
    """

    def __init__(self, keep: int = 100_000):
        self.keep, self._rows, self._lock = keep, [], threading.Lock()
        self.failures: dict[str, str] = {}

    def attach(self, spark: SparkSession) -> BatchLog:
        spark.streams.addListener(self)
        return self

    def detach(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's names
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        time = lambda text: datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None
        row = (
            p.name, str(p.runId), p.batchId, time(p.timestamp), p.numInputRows, p.batchDuration / 1000,
            time(p.eventTime.get("watermark")), sum(s.numRowsTotal for s in p.stateOperators),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        )
        with self._lock:
            self._rows.append(row)
            del self._rows[: -self.keep]

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.failures[str(event.runId)] = event.exception

    def table(self, spark: SparkSession) -> DataFrame:
        """The batches so far."""
        with self._lock:
            return spark.createDataFrame(list(self._rows), SCHEMA)


def intervals(batches: DataFrame) -> DataFrame:
    """Per query: its batches with rows, their rows, and seconds between the starts of one batch and the next."""
    from pyspark.sql import Window

    in_order = Window.partitionBy("query", "run").orderBy("batch")
    gap = F.col("started").cast("double") - F.lag("started").over(in_order).cast("double")
    return batches.withColumn("gap", gap).groupBy("query").agg(
        F.count_if(F.col("rows") > 0).alias("batches"), F.sum("rows").alias("rows"),
        F.min("gap").alias("least_interval"), F.max("gap").alias("largest_interval"), F.max("seconds").alias("longest_batch"),
    )
