"""Streaming twins of the batch queries, fed by the same tables as bounded streams.

Each runs until it has read all there is, writes its micro-batches to the shared
folder, and is read back as a table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtally.operators import dashboards, enrich
from airtally.operators.changes import latest_by_key
from airtally.plans import panels, viewing  # noqa: F401  the batch twins come first
from airtally.plans.records import EVENT
from airtally.plans.registry import query
from airtally.plans.views import Views
from airtally.session import new_folder, state_partitions
from airtally.sources.feeds import LATE, ads_from_topic
from airtally.sources.topics import topic_decode
from airtally.streaming import joins, latest, parts, state
from airtally.streaming.runner import Live, kept, table_sink


class Streams(Views):
    """The test views with one table read as a stream."""

    def __init__(self, views: Views, flowing: str = "events"):
        super().__init__(views.spark, views.folder)
        self.flowing = flowing

    def table(self, name: str) -> DataFrame:
        still = super().table(name)
        if name != self.flowing:
            return still
        # As a pattern, since a stream takes a folder or a pattern but not a single file.
        path = os.path.join(self.folder, f"[{name[0]}]{name[1:]}.parquet")
        return self.spark.readStream.schema(still.schema).parquet(path)


def finish(rows: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None,
           step: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    folder = new_folder(rows.sparkSession, "live")
    live = Live(name, rows, mode, step=step)
    table_sink(live, folder).awaitTermination()
    return kept(live, folder, keys)


def from_table(df: DataFrame, name: str) -> DataFrame:
    """A bounded DataFrame as a stream: written once, read back as files."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


@query("device_sessions_live", same_as="device_sessions")
def device_sessions_live(v: Views):
    found = state.device_sessions_stream(Streams(v).actions(), tiebreak="event_id", mode="append",
                                         clock=state.NEVER)
    return finish(found, "sessions")


@query("user_activity_live", same_as="user_activity")
def user_activity_live(v: Views):
    found = state.activity_parts_stream(Streams(v).typed_events(), tiebreak="event_id", clock=state.NEVER)
    return viewing.whole_lists(state.activity_days(finish(found, "activity")))


@query("user_activity_batches_live", same_as="user_activity")
def user_activity_batches_live(v: Views):
    """The same over several micro-batches, each sending on only what it adds."""
    flow = in_batches(v.typed_events(), "event-stream", "event_ts")
    found = state.activity_parts_stream(flow, tiebreak="event_id", clock=state.NEVER)
    return viewing.whole_lists(state.activity_days(finish(found, "activity")))


@query("type_spans_live", same_as="type_spans")
def type_spans_live(v: Views):
    return finish(state.type_spans_stream(Streams(v).typed_events(), clock=state.NEVER), "spans")


@query("sliding_event_stats_live", same_as="sliding_event_stats")
def sliding_event_stats_live(v: Views):
    stats = dashboards.sliding_event_stats(Streams(v).events())
    flat = stats.select(F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), "event_type", "avg", "count", "sum")
    return finish(flat, "stats", "complete")


@query("device_place_tumbling_live", same_as="device_place_tumbling")
def device_place_tumbling_live(v: Views):
    marked = Streams(v).locations().withWatermark("kdts", LATE["place"])
    stats = dashboards.device_place_tumbling(marked, "kdts")
    flat = stats.select(F.col("window.start").alias("window_start"), "device_id", "location",
                        F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "visibility")
    return finish(flat, "places", "update", ["window_start", "device_id", "location"])


@query("count_by_type_live", sql="SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def count_by_type_live(v: Views):
    return finish(dashboards.count_by(Streams(v).events(), "event_type"), "counts", "complete")


@query("poor_events_live", sql="SELECT event_id, event_type FROM events WHERE value < 3")
def poor_events_live(v: Views):
    rows = Streams(v).events().filter("value < 3").select("event_id", "event_type")
    return finish(rows, "poor")


@query("event_customer_join_live", same_as="event_customer_join")
def event_customer_join_live(v: Views):
    events = Streams(v).events().select("event_id", "event_type", "event_ts", "event_amount",
                                        F.col("user_id").alias("customer_id"))
    people = v.customers().select("id", "last_name", "club_status", "nation")
    # Joined a micro-batch at a time, so that the batch's heavy customers are counted and spread.
    return finish(events, "joined", step=lambda batch: enrich.event_customer_join(batch, people))


@query("ratings_enriched_live", same_as="ratings_enriched")
def ratings_enriched_live(v: Views):
    """Ratings meet the newest version of a customer table that a second stream keeps."""
    folder = new_folder(v.spark, "customers")
    came = v.customer_changes().withColumn("came", F.timestamp_seconds(F.col("version") * 1000 + F.col("id") % 1000))
    flow = in_batches(came, "customer-stream", "came").drop("came")
    latest.keep_latest(flow, folder, ["id"], ["version"]).awaitTermination()

    def joined(batch: DataFrame) -> DataFrame:
        return enrich.with_customers(batch, latest.latest_table(v.spark, folder, flow.schema, ["id"], ["version"]))
    return finish(Streams(v, "orders").ratings(), "rated", step=joined)


@query("unhappy_by_name_live", same_as="unhappy_by_name")
def unhappy_by_name_live(v: Views):
    rated = enrich.ratings_enriched(Streams(v, "orders").ratings(), v.customer_changes(), ["version"])
    alerts = enrich.unhappy_premium(rated, status="BUILDING")
    return finish(dashboards.count_by(alerts, "full_name"), "alerts", "complete")


@query("latest_by_key_live", same_as="latest_by_key")
def latest_by_key_live(v: Views):
    """The table view of a change stream, kept up to date in update mode."""
    newest = latest_by_key(Streams(v, "orders").changes(), ["key"], ["timestamp", "offset"])
    slim = newest.select("key", "op", "offset", F.col("after.status").alias("status"))
    return finish(slim, "newest", "update", ["key"])


@query("latest_table_live", same_as="latest_by_key")
def latest_table_live(v: Views):
    """The same kept as a table over several micro-batches: deltas, merged into versions."""
    folder = new_folder(v.spark, "newest")
    slim = v.changes().select("key", "op", "offset", "timestamp", F.col("after.status").alias("status"))
    flow = in_batches(slim, "change-stream", "timestamp")
    latest.keep_latest(flow, folder, ["key"], ["timestamp", "offset"]).awaitTermination()
    newest = latest.latest_table(v.spark, folder, flow.schema, ["key"], ["timestamp", "offset"])
    return newest.select("key", "op", "offset", "status")


@query("topic_json_decode_live", same_as="topic_json_decode")
def topic_json_decode_live(v: Views):
    return finish(topic_decode(Streams(v).envelope(), EVENT), "decoded")


@query("show_watch_overlap_live", same_as="show_watch_overlap")
def show_watch_overlap_live(v: Views):
    sessions = from_table(v.sessions(), "session-stream")
    return finish(joins.show_views_live(sessions, v.shows_table()).drop("mark_ts"), "shows")


@query("ad_view_overlap_live", same_as="ad_view_overlap")
def ad_view_overlap_live(v: Views):
    sessions = from_table(v.sessions(), "session-stream").withWatermark("end_ts", LATE["session"])
    ads = ads_from_topic(Streams(v).ad_starts()).withWatermark("start_ts", LATE["ad"])
    return finish(joins.ad_views_live(ads, sessions).drop("mark_ts"), "ads")


# Micro-batches of the event tables for the queries below, and the days that one holds.
BATCHES, BATCH_DAYS = 6, 6
# Rows of a file of theirs.
FILE_ROWS = 250_000


def in_batches(df: DataFrame, name: str, at: str, closing: dict[str, Column] | None = None,
               batches: int = BATCHES) -> DataFrame:
    """A bounded DataFrame as a stream of ``batches`` micro-batches in the order of ``at``.

    With ``closing`` (columns of a last row that meets nothing, the others null) one more batch
    comes, whose time lets everything before it leave the state. A batch has as many files as its rows
    are worth, every batch equally many, since a stream takes a number of files at a time, the oldest first.
    """
    spark, path, dealt = df.sparkSession, new_folder(df.sparkSession, name), new_folder(df.sparkSession, f"{name}-dealt")
    number = F.unix_micros(at).cast("double")
    low, high, total = df.agg(F.min(number), F.max(number), F.count(F.lit(1))).first()
    width = ((high or 0.0) - (low or 0.0)) / batches + 1.0
    part = F.coalesce(F.floor((number - F.lit(low or 0.0)) / F.lit(width)), F.lit(0)).cast("int")
    # Dealt in one pass by all tasks; each batch then reads its own rows only.
    df.withColumn("in_batch", part).write.partitionBy("in_batch").parquet(dealt)
    files = max(1, min(state_partitions(spark), total // batches // FILE_ROWS))
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("in_batch", T.IntegerType())])).parquet(dealt)
    none = spark.createDataFrame([], df.schema)
    for k in range(batches):
        here = rows.where(F.col("in_batch") == k).drop("in_batch")
        (here.repartition(files) if files > 1 else here.coalesce(1)).write.mode("append").parquet(path)
        # A task without rows writes no file; an empty one stands for it.
        missing = files * (k + 1) - len(spark.read.schema(df.schema).parquet(path).inputFiles()) if files > 1 else 0
        for _ in range(missing):
            none.coalesce(1).write.mode("append").parquet(path)
    if closing:
        one = spark.range(1).select(*[closing[f.name].cast(f.dataType).alias(f.name) if f.name in closing
                                      else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        one.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _end(days: int) -> Column:
    """A time well after the test events."""
    return F.to_timestamp(F.lit("2024-02-01 00:00:00")) + F.expr(f"INTERVAL {days} DAYS")


def _nobody(key: int) -> dict[str, Column]:
    """Keys that meet nothing. Nulls would not do, here or in times: Spark filters them out below the watermark."""
    return {name: F.lit(key) for name in ("user_id", "device_id", "channel_id")}


@query("device_sessions_idle_live", same_as="device_sessions_idle")
def device_sessions_idle_live(v: Views):
    """Sessions with an idle time-out on event time over several micro-batches; early actions that
    come again in the last one are late and change nothing."""
    actions = v.actions()
    again = actions.where("action_ts < TIMESTAMP '2024-01-02 00:00:00'")
    order = actions.withColumn("sent", F.col("action_ts")).unionByName(again.withColumn("sent", _end(1)))
    flow = in_batches(order, "action-stream", "sent", {"action_ts": _end(30), "sent": _end(30)})
    idle = state.device_sessions_stream(flow.withWatermark("action_ts", "1 minute"), 6 * 3_600_000, "append",
                                        "event_id", state.EVENT)
    return finish(idle, "idle")


def session_parts(v: Views) -> DataFrame:
    """The sessions of the test events as parts, with the micro-batch each came in."""
    flow = in_batches(v.actions(), "action-stream", "action_ts")
    found = state.session_parts_stream(flow.withWatermark("action_ts", "1 minute"), parts.PART, "event_id")
    folder = new_folder(v.spark, "live")
    live = Live("parts", found)
    table_sink(live, folder).awaitTermination()
    return v.spark.read.schema(found.schema.add("batch", "long")).parquet(f"{folder}/parts/rows")


def parts_stream(sent: DataFrame) -> DataFrame:
    """The parts as they came, batch by batch, and their end."""
    late = f"{BATCH_DAYS} days"
    flow = in_batches(sent.withColumn("came", F.timestamp_micros(F.col("batch") * 1_000_000)), "part-stream", "came",
                      {"part_start": _end(30), "part_end": _end(30), "came": _end(30), **_nobody(-2)}, batches=BATCHES + 2)
    return parts.in_cell(flow.drop("came", "batch"), "part_start", late)


def point_stream(v: Views) -> DataFrame:
    flow = in_batches(v.locations(), "point-stream", "kdts", {"kdts": _end(30), **_nobody(-3)})
    return parts.in_cell(flow, "kdts", LATE["location"])


def ad_stream(v: Views) -> DataFrame:
    """Ads cut into cells, in micro-batches."""
    from airtally.plans.viewing import ads

    flow = in_batches(ads(v), "ad-stream", "start_ts", {"start_ts": _end(30), "end_ts": _end(30), **_nobody(-1)})
    return parts.in_parts(flow, "start_ts", "end_ts", LATE["ad"])


@query("session_parts_live", same_as="device_sessions")
def session_parts_live(v: Views):
    """Sessions sent on a part at a time while they are open, put together again."""
    return parts.whole_sessions(session_parts(v))


@query("show_watch_live", same_as="show_watch_full")
def show_watch_live(v: Views):
    """The flagship as streaming queries over several micro-batches, with views nobody was located in."""
    sent = session_parts(v)
    rows = finish(parts.show_watch_parts(parts_stream(sent), v.shows_table(), v.users(), point_stream(v)), "watch")
    return parts.whole_views(rows, parts.ended(sent), parts.SHOW)


@query("ad_view_live", same_as="ad_view_full")
def ad_view_live(v: Views):
    """The ad pipeline as streaming queries over several micro-batches."""
    sent = session_parts(v)
    rows = finish(parts.ad_watch_parts(ad_stream(v), parts_stream(sent), v.users(), point_stream(v)), "ads-watched")
    return parts.whole_views(rows, parts.ended(sent), parts.AD)


@query("ad_unseen_live", ["ads", "sessions"], """
SELECT a.ad_id, a.channel_id, a.start_ts, a.end_ts FROM ads a
WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.channel_id = a.channel_id
                  AND s.start_ts <= a.end_ts AND s.end_ts >= a.start_ts)""")
def ad_unseen_live(v: Views):
    """Ads no session reached, given out once their cells have passed."""
    sent = session_parts(v)
    rows = finish(parts.ad_view_parts(ad_stream(v), parts_stream(sent), "left_outer"), "ads-unseen")
    return parts.unseen_ads(rows, parts.ended(sent))
