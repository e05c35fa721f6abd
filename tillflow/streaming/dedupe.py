"""Copies of messages removed from a stream, with state that ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow.operators.analytics import LATENESS
from tillflow.streaming.sinks import stream_to_files


def without_copies(df: DataFrame, keys: list[str], time: str, within: str = LATENESS) -> DataFrame:
    """The first row of each key among rows whose times are less than ``within`` apart.

    A key is remembered until the watermark, ``within`` behind the latest time,
    has passed its first row by that much; a copy that comes after that is late
    itself and is dropped as such, if its time is the same.  Rows without time
    can't be remembered for any time and are left out.
    """
    known = df.where(F.col(time).isNotNull())
    return known.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)


def start_deduped(
    df: DataFrame, keys: list[str], time: str, path: str, checkpoint: str, trigger: str | None = None, name: str | None = None,
    within: str = LATENESS,
) -> StreamingQuery:
    return stream_to_files(without_copies(df, keys, time, within), path, checkpoint, trigger, name=name)
