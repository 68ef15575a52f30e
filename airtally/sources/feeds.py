"""The feeds of the viewing pipeline, from topics or from files, in one shape.

Watermarks are set here and nowhere else: Spark refuses a second one downstream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtally.functions.timecols import (ISO_MILLIS, LOCATION_TIME, rebase_time, seconds_after,
                                         string_to_ts)
from airtally.functions.values import remap_values
from airtally.sources.files import json_stream, json_table
from airtally.sources.topics import topic_decode, topic_source


def fields(**kinds: str | T.DataType) -> T.StructType:
    """A schema from names and types, such as ``fields(age="integer")``."""
    schema = T.StructType()
    for name, kind in kinds.items():
        schema.add(name, kind)
    return schema


# The fields of each feed, as files and as topic messages.
ACTION = fields(user="string", user_id="integer", channel_id="integer", device_id="integer",
                action="integer", action_ts="timestamp")
SESSION_FILE = fields(user_id="integer", device_id="integer", channel_id="integer",
                      start_ts="timestamp", end_ts="timestamp")
SESSION_TOPIC = fields(user_id="integer", device_id="integer", channel_id="integer",
                       start="string", end="string")
AD_FILE = fields(ad_id="integer", channel_id="integer", start_ts="timestamp", end_ts="timestamp")
AD_TOPIC = fields(ad_id="integer", channel_id="integer", start_ts="timestamp", duration_secs="integer")
USER_FILE = fields(user_id="integer", name="string", age="integer", gender="string")
USER_TOPIC = fields(ID="integer", user_name="string", age="integer", gender="string")
LOCATION_FILE = fields(device_id="integer", name="string", visibility="integer",
                       coord=fields(lon="float", lat="float"))
LOCATION_TOPIC = fields(kdct="string", name="string", visibility="integer", lon="float", lat="float")
LOCATION_KEY = fields(id="integer")
# Views with viewer, as saved between two steps of the pipeline.
SHOW_VIEW = fields(program_id="integer", channel_id="integer", program="string", channel="string",
                   user_id="integer", device_id="integer", name="string", age="integer",
                   gender="string", start_ts="string", end_ts="string")
SHOW = fields(program="string", program_id="integer", start="string")
CHANNEL = fields(channel="string", channel_id="integer",
                 schedule=T.MapType(T.StringType(), T.ArrayType(SHOW)))
# Where the recorded positions start, where they are moved to, device numbers.
RECORDED_FROM, MOVED_TO = "2021/05/18 10:30:12", "2021/02/01 23:55:00"
DEVICE_NUMBERS = {2963597: 14, 4924733: 15, 4254884: 16, 3865483: 17, 3895114: 18}
# How late rows of each feed may come.
LATE = {"ad": "1 minute", "session": "1 minute", "view": "90 seconds",
        "location": "60 seconds", "event": "30 seconds", "place": "5 seconds"}


def sessions_from_topic(decoded: DataFrame) -> DataFrame:
    """Session messages: ISO text to timestamps."""
    timed = string_to_ts(string_to_ts(decoded, "start", "start_ts", ISO_MILLIS),
                         "end", "end_ts", ISO_MILLIS)
    return timed.select("user_id", "device_id", "channel_id", "start_ts", "end_ts")


def ads_from_topic(decoded: DataFrame) -> DataFrame:
    """Ad messages: the end follows from start and duration."""
    return decoded.select("ad_id", "channel_id", "start_ts",
                          seconds_after(F.col("start_ts"), F.col("duration_secs")).alias("end_ts"))


def users_from_topic(decoded: DataFrame) -> DataFrame:
    """User messages under the names the joins use."""
    return decoded.select(F.col("ID").alias("user_id"), F.col("user_name").alias("name"),
                          "age", "gender")


def locations_from_topic(decoded: DataFrame, first: str = RECORDED_FROM, base: str = MOVED_TO,
                         devices: dict[int, int] | None = None) -> DataFrame:
    """Position messages: text to time, moved to the demo day, device numbers mapped."""
    named = decoded.withColumnsRenamed({"id": "device_id", "name": "location"})
    timed = rebase_time(string_to_ts(named, "kdct", "kdctts", LOCATION_TIME),
                        "kdctts", first, base)
    mapped = remap_values(timed, DEVICE_NUMBERS if devices is None else devices, ["device_id"])
    return mapped.select("device_id", "location", "kdts", "lat", "lon", "visibility")


def views_from_topic(decoded: DataFrame) -> DataFrame:
    """Views saved to a topic and read back: their times return as text."""
    timed = string_to_ts(string_to_ts(decoded, "start_ts", "start_ts", ISO_MILLIS),
                         "end_ts", "end_ts", ISO_MILLIS)
    return timed.drop("msgoffset", "msgtime")


def locations_from_file(rows: DataFrame) -> DataFrame:
    """Position files: the coordinates as columns."""
    return rows.select("device_id", F.col("name").alias("location"), "visibility", "coord.*")


@dataclass(frozen=True)
class Feeds:
    """Where the feeds come from: a topic location, or a folder of JSON files."""

    spark: SparkSession
    location: str
    from_topics: bool = True
    stream: bool = True

    def _topic(self, topic: str, schema: T.StructType, key: T.StructType | None = None,
               offset: int = 0) -> DataFrame:
        return topic_decode(topic_source(self.spark, self.location, topic, offset, self.stream),
                            schema, key)

    def _files(self, stem: str, schema: T.StructType) -> DataFrame:
        path = f"{self.location}/{stem}*.json"
        if self.stream:
            return json_stream(self.spark, path, schema)
        return json_table(self.spark, path, schema)

    def _marked(self, df: DataFrame, ts: str, late: str) -> DataFrame:
        return df.withWatermark(ts, LATE[late]) if self.stream else df

    def actions(self, topic: str = "action", offset: int = 0) -> DataFrame:
        rows = self._topic(topic, ACTION, offset=offset) if self.from_topics \
            else self._files("action", ACTION)
        return rows.select(*ACTION.fieldNames())

    def sessions(self, topic: str = "session", offset: int = 0) -> DataFrame:
        rows = sessions_from_topic(self._topic(topic, SESSION_TOPIC, offset=offset)) \
            if self.from_topics else self._files("session", SESSION_FILE)
        return self._marked(rows, "end_ts", "session")  # a session is known when it ends

    def ads(self, topic: str = "ad", offset: int = 0) -> DataFrame:
        rows = ads_from_topic(self._topic(topic, AD_TOPIC, offset=offset)) \
            if self.from_topics else self._files("ad", AD_FILE)
        return self._marked(rows, "start_ts", "ad")

    def users(self, topic: str = "user", offset: int = 0) -> DataFrame:
        if self.from_topics:
            return users_from_topic(self._topic(topic, USER_TOPIC, offset=offset))
        return self._files("user", USER_FILE)

    def locations(self, topic: str = "device_loc", offset: int = 0) -> DataFrame:
        """Positions; those in files carry no time and so no watermark."""
        if not self.from_topics:
            return locations_from_file(self._files("device_loc", LOCATION_FILE))
        rows = locations_from_topic(self._topic(topic, LOCATION_TOPIC, LOCATION_KEY, offset))
        return self._marked(rows, "kdts", "location")
