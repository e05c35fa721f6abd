"""Time parsing and calendar parts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed_time(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; text that is no time becomes null, not an error."""
    if dict(df.dtypes)[name] == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def stamp(run_ts: datetime | str | None) -> Column:
    """The run's time stamp: the caller's fixed value, or the query's own start."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(str(run_ts)).cast("timestamp")


def day_parts(time: Column, prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_year": F.year(time),
        f"{prefix}_month": F.month(time),
        f"{prefix}_day": F.dayofmonth(time),
    }


def day_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")
