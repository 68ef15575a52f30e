"""Viewing joins on streams whose state has a bound from the data.

A session is known as a whole only when it ends, so an ad or a position would have to wait for
the longest session there may ever be. Here time is cut into cells of ``PART`` seconds. Open sessions
are sent on a part at a time (``state.session_parts_stream``), ads are cut as they come, positions fall
into one cell, and the joins ask for the same cell on both sides. The cell carries the
watermark, so Spark drops either side's rows of a cell once it has passed: nothing waits for longer
than a cell and the lateness of the feed, and no pair is lost.

What comes out is a row per pair and cell. ``whole_views`` puts the parts of a view together and
leaves out sessions that never ended; it reads what the stream has written so far.

Cases: rows with a null key or time meet nothing; intervals that run backwards are left out; a session,
ad or show given twice with equal times counts once, repeated positions count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airtally.streaming.meet import meet_stream

#: Seconds of a cell.
PART = 6 * 3600
SHOW = ["program_id", "program", "channel_id", "channel", "show_start"]
AD = ["ad_id", "channel_id", "ad_start", "ad_end"]
SESSION = ["user_id", "device_id", "session_start"]
POINT = ["device_id", "lon", "lat", "visibility", "kdts"]


def _cell_number(at: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(seconds * 1_000_000))


def _cell_start(number: Column, seconds: int) -> Column:
    return F.timestamp_micros(number * F.lit(seconds * 1_000_000))


def in_cell(df: DataFrame, at: str, late: str, seconds: int = PART) -> DataFrame:
    """Rows with the ``cell`` their time lies in, marked by it. ``late`` is how far a row may come
    behind the newest; a cell stays open for its own length more."""
    marked = df.withColumn("cell", _cell_start(_cell_number(at, seconds), seconds))
    if not df.isStreaming:
        return marked
    return marked.withWatermark("cell", f"{seconds} seconds {late}")


def in_parts(df: DataFrame, start: str, end: str, late: str, seconds: int = PART) -> DataFrame:
    """A row for each cell an interval touches, with ``part_start`` and ``part_end`` inside it."""
    cells = (df.where(F.col(start) <= F.col(end)).withColumn(
        "number", F.explode(F.sequence(_cell_number(start, seconds), _cell_number(end, seconds)))))
    begins, ends = _cell_start(F.col("number"), seconds), _cell_start(F.col("number") + 1, seconds)
    return in_cell(cells.withColumns({"part_start": F.greatest(start, begins), "part_end": F.least(end, ends)})
                   .drop("number"), "part_start", late, seconds)


def show_view_parts(parts: DataFrame, shows: DataFrame) -> DataFrame:
    """Parts of sessions x static shows; nothing is kept in state."""
    on_air = shows.select("program_id", "program", F.col("channel_id").alias("show_channel"), "channel",
                          F.col("start_ts").alias("show_start"), F.col("end_ts").alias("show_end"))
    touch = ((F.col("channel_id") == F.col("show_channel")) & (F.col("part_start") <= F.col("show_end"))
             & (F.col("part_end") >= F.col("show_start")))
    return parts.join(on_air, touch).select(
        *SHOW, *SESSION, "cell", F.greatest("part_start", "show_start").alias("start_ts"),
        F.least("part_end", "show_end").alias("end_ts"))


def ad_view_parts(ads: DataFrame, parts: DataFrame, how: str = "inner") -> DataFrame:
    """Parts of ads (``in_parts``) x parts of sessions; ``left_outer`` keeps parts of ads nobody saw."""
    shown = ads.select("ad_id", "channel_id", F.col("start_ts").alias("ad_start"), F.col("end_ts").alias("ad_end"),
                       F.col("part_start").alias("shown_from"), F.col("part_end").alias("shown_to"), "cell")
    seen = parts.select(*SESSION, F.col("channel_id").alias("seen_channel"), F.col("cell").alias("seen_cell"),
                        "part_start", "part_end")
    touch = ((F.col("channel_id") == F.col("seen_channel")) & (F.col("cell") == F.col("seen_cell"))
             & (F.col("part_start") <= F.col("shown_to")) & (F.col("part_end") >= F.col("shown_from")))
    return shown.join(seen, touch, how).select(
        *AD, *SESSION, "cell", F.greatest("part_start", "shown_from").alias("start_ts"),
        F.least("part_end", "shown_to").alias("end_ts"))


def _kind(df: DataFrame, column: str) -> str:
    """Numbers and text are kept in groups; others have names of their own here and stay in a join."""
    kind = df.schema[column].dataType
    return "number" if isinstance(kind, T.IntegralType) else "text" if kind == T.StringType() else f"{column}: {kind}"


def with_points(views: DataFrame, points: DataFrame) -> DataFrame:
    """Parts of views with each position of their device inside them (``in_cell``), or nulls."""
    seen = points.select(*POINT, F.col("cell").alias("point_cell"))
    named = views.withColumnRenamed("device_id", "view_device_id")
    if views.isStreaming and points.isStreaming and (_kind(named, "view_device_id") == _kind(seen, "device_id")):
        return meet_stream(named, seen, ("view_device_id", "device_id"), "start_ts", "end_ts", "kdts", ("cell", "point_cell"))
    inside = ((F.col("view_device_id") == F.col("device_id")) & (F.col("cell") == F.col("point_cell"))
              & (F.col("start_ts") <= F.col("kdts")) & (F.col("end_ts") >= F.col("kdts")))
    return named.join(seen, inside, "left_outer").drop("point_cell")


def show_watch_parts(parts: DataFrame, shows: DataFrame, users: DataFrame, points: DataFrame) -> DataFrame:
    """The whole show pipeline as one streaming query, by parts."""
    people = users.select("user_id", "name", "age", "gender")
    return with_points(show_view_parts(parts, shows).join(people, "user_id"), points)


def ad_watch_parts(ads: DataFrame, parts: DataFrame, users: DataFrame, points: DataFrame) -> DataFrame:
    """The whole ad pipeline as one streaming query, by parts."""
    people = users.select("user_id", "name", "age", "gender")
    return with_points(ad_view_parts(ads, parts).join(people, "user_id"), points)


def ended(parts: DataFrame) -> DataFrame:
    """(user_id, device_id, channel_id, session_start) of the sessions with an end."""
    return parts.where("closed").select("user_id", "device_id", "channel_id", "session_start").distinct()


def whole_sessions(parts: DataFrame) -> DataFrame:
    """The ended sessions, from their parts."""
    key = ["user_id", "device_id", "channel_id", "session_start"]
    return (parts.groupBy(*key).agg(F.max("part_end").alias("end_ts"), F.max("closed").alias("closed"))
            .where("closed").select(*key[:3], F.col("session_start").alias("start_ts"), "end_ts"))


def whole_views(rows: DataFrame, sessions: DataFrame, what: list[str], points: bool = True) -> DataFrame:
    """Views of ended sessions from rows by part: ``what`` (``SHOW`` or ``AD``) and the session name a view.

    With ``points`` a view comes once per position, or once with nulls; the positions of a view
    are joined to its interval, as both are known by key only here.
    """
    device = "view_device_id" if points else "device_id"
    key = [*what, "user_id", device, "session_start"]
    known = sessions.select("user_id", F.col("device_id").alias(device), "channel_id", "session_start")
    kept = rows.join(known, ["user_id", device, "channel_id", "session_start"], "left_semi")
    more = [c for c in rows.columns if c not in (*key, "cell", "start_ts", "end_ts", *(POINT if points else []))]
    views = kept.groupBy(*key, *more).agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
    if points:
        found = kept.where(F.col("kdts").isNotNull()).select(*key, *POINT)
        views = views.join(found, key, "left")
    return views.drop("session_start", "show_start", "ad_start", "ad_end")


def unseen_ads(rows: DataFrame, sessions: DataFrame) -> DataFrame:
    """Ads without a view, with their own interval, from ``ad_view_parts`` with ``left_outer``."""
    seen = whole_views(rows.where(F.col("user_id").isNotNull()), sessions, AD, points=False).select("ad_id", "channel_id").distinct()
    every = rows.select(*AD).distinct()
    return every.join(seen, ["ad_id", "channel_id"], "left_anti").select(
        "ad_id", "channel_id", F.col("ad_start").alias("start_ts"), F.col("ad_end").alias("end_ts"))
