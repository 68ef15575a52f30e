"""Timestamp columns: parsing, expanding, shifting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text formats of the feeds.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
SHOW_START = "dd-MM-yyyy HH:mm:ss"
SHOW_DAY = "dd-MM-yyyy"
LOCATION_TIME = "yyyy/MM/dd HH:mm:ss"
ROW_TIME = "yyyy-MM-dd HH:mm:ss"


def millis_to_ts(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Epoch milliseconds to a timestamp, milliseconds kept."""
    return df.withColumn(dst, F.timestamp_millis(F.col(src).cast("bigint")))


def string_to_ts(df: DataFrame, src: str, dst: str, fmt: str) -> DataFrame:
    """Formatted text to a timestamp; text that does not fit becomes null."""
    return df.withColumn(dst, F.try_to_timestamp(F.col(src), F.lit(fmt)))


def expand_timestamp(df: DataFrame, ts: str, prefix: str | None = None) -> DataFrame:
    """Add date, clock text, month, day, hour and minute columns of ``ts``.

    The prefix defaults to the part of the column name before ``_ts``.
    """
    stem = prefix or ts.partition("_ts")[0]
    at = F.col(ts)
    parts = {"date": F.to_date(at), "time": F.date_format(at, "H:m:s"),
             "month": F.month(at), "day": F.dayofmonth(at),
             "hour": F.hour(at), "min": F.minute(at)}
    return df.withColumns({f"{stem}_{name}": part for name, part in parts.items()})


def seconds_after(start: Column, seconds: Column) -> Column:
    """``start`` plus a whole number of seconds."""
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def rebase_time(df: DataFrame, ts: str, first: str, base: str, dst: str = "kdts",
                fmt: str = LOCATION_TIME) -> DataFrame:
    """Move a series in time so that the instant ``first`` falls on ``base``."""
    def instant(text: str) -> Column:
        return F.to_timestamp(F.lit(text), fmt)
    at = F.col(ts).cast(T.TimestampType())
    return df.withColumn(dst, instant(base) + (at - instant(first)))


def seconds_ago(df: DataFrame, ts: str, now: Column | None = None, dst: str = "ago") -> DataFrame:
    """Whole seconds between ``ts`` and ``now`` (the query's own clock by default)."""
    now = F.current_timestamp() if now is None else now
    return df.withColumn(dst, F.unix_seconds(now) - F.unix_seconds(F.col(ts).cast("timestamp")))


def time_text(ts: Column, fmt: str = ROW_TIME) -> Column:
    """A timestamp as text."""
    return F.date_format(ts, fmt)
