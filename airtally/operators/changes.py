"""Change streams and record transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.functions.timecols import LOCATION_TIME, time_text

# Fixed value: operation code of a deleted row.
DELETE = "d"


def unwrap_changes(changes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The row after each change (``after.*``); deletes and tombstones go."""
    alive = changes.filter((F.col("op") != DELETE) & F.col("after").isNotNull())
    return alive.select(*(keep or []), "after.*")


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    ``max_by`` combines before the shuffle, so a key with very many versions
    sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("newest"))
    return newest.select(*keys, "newest.*").select(*df.columns)


def latest_alive(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Table view of a change stream: the latest state of each key, without keys
    whose last change was a delete."""
    return unwrap_changes(latest_by_key(changes, keys, order), keep=keys)


def key_from_value(df: DataFrame, field: str, key: str = "key") -> DataFrame:
    """Copy a value field to the message key."""
    return df.withColumn(key, F.col(field))


def insert_fields(df: DataFrame, static: dict[str, str] | None = None,
                  topic_field: str | None = None, ts_field: str | None = None) -> DataFrame:
    """Add fixed fields, the topic name and the record time under chosen names."""
    added = {name: F.lit(value) for name, value in (static or {}).items()}
    if topic_field:
        added[topic_field] = F.col("topic")
    if ts_field:
        added[ts_field] = F.col("timestamp")
    return df.withColumns(added) if added else df


def insert_time_text(df: DataFrame, field: str = "myct", now: Column | None = None) -> DataFrame:
    """Add the current time as ``yyyy/MM/dd HH:mm:ss`` text."""
    now = F.current_timestamp() if now is None else now
    return df.withColumn(field, time_text(now, LOCATION_TIME))


def route_by_regex(df: DataFrame, pattern: str, to: str, topic: str = "topic") -> DataFrame:
    """Rename the topic where the whole name fits ``pattern``; ``$1`` refers to groups."""
    whole = F.col(topic).rlike(f"^(?:{pattern})$")
    renamed = F.regexp_replace(F.col(topic), f"^(?:{pattern})$", to)
    return df.withColumn(topic, F.when(whole, renamed).otherwise(F.col(topic)))


def route_by_month(df: DataFrame, ts: str = "timestamp", topic: str = "topic") -> DataFrame:
    """Send each record to ``kafka-<topic>-<yyyy-MM>``."""
    return df.withColumn(topic, F.concat(
        F.lit("kafka-"), F.col(topic), F.lit("-"), F.date_format(ts, "yyyy-MM")))


def ts_to_text(df: DataFrame, ts: str, fmt: str) -> DataFrame:
    """Replace a timestamp field by formatted text."""
    return df.withColumn(ts, F.date_format(ts, fmt))
