"""The viewing joins on streams.

Watermarks come with the feeds and are never set again here. A session is marked by
its end, as it is only known then; an ad by its start. Spark drops a row from the
join state by its marked column alone, so a join states the bounds on the marks that
follow from the intervals: a session leaves when no ad can reach it any more.
The other bound needs ``longest``, how long a session and an ad may be together.
Without it (the default) no pair is lost and ads and positions stay in the state;
with it they leave, and pairs further apart are not found.
Of a stream-stream join one mark goes on, as ``mark_ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.operators.intervals import interval_overlap


def _reach(early: Column, mark: Column, longest: str | None) -> Column:
    """Whether the earlier mark is at most ``longest`` before the other; always so without it."""
    return F.lit(True) if longest is None else early >= mark - F.expr(f"INTERVAL {longest}")


def show_views_live(sessions: DataFrame, shows: DataFrame, method: str = "cells") -> DataFrame:
    """Session stream x static shows; nothing here is kept in state. ``plain`` plans
    each micro-batch a little quicker, where no channel is busy."""
    pairs = interval_overlap(sessions, shows, "channel_id", method=method)
    return pairs.select(
        F.col("b_program_id").alias("program_id"), F.col("b_program").alias("program"),
        F.col("b_channel_id").alias("channel_id"), F.col("b_channel").alias("channel"),
        F.col("a_user_id").alias("user_id"), F.col("a_device_id").alias("device_id"),
        "start_ts", "end_ts", F.col("a_end_ts").alias("mark_ts"))


def ad_views_live(ads: DataFrame, sessions: DataFrame, how: str = "inner",
                  longest: str | None = None) -> DataFrame:
    """Ad stream x session stream; ``left_outer`` emits an unseen ad, with its own
    interval, once no session can reach it any more. That is known only with ``longest``."""
    if how != "inner" and longest is None:
        raise ValueError("unseen ads need longest, the time after which no session can reach an ad")
    seen = ads.select("ad_id", F.col("channel_id").alias("ad_channel"),
                      F.col("start_ts").alias("ad_start"), F.col("end_ts").alias("ad_end"))
    watched = sessions.select("user_id", "device_id", F.col("channel_id").alias("session_channel"),
                              F.col("start_ts").alias("session_start"),
                              F.col("end_ts").alias("session_end"))
    touch = ((F.col("ad_channel") == F.col("session_channel"))
             & (F.col("session_start") <= F.col("ad_end"))
             & (F.col("session_end") >= F.col("ad_start"))
             & _reach(F.col("ad_start"), F.col("session_end"), longest))
    return seen.join(watched, touch, how).select(
        "ad_id", F.col("ad_channel").alias("channel_id"), "user_id", "device_id",
        F.greatest("session_start", "ad_start").alias("start_ts"),
        F.least("session_end", "ad_end").alias("end_ts"), F.col("session_end").alias("mark_ts"))


def with_demographics_live(views: DataFrame, users: DataFrame) -> DataFrame:
    """View stream x user table."""
    return views.join(users.select("user_id", "name", "age", "gender"), "user_id")


def with_locations_live(views: DataFrame, locations: DataFrame, how: str = "left_outer",
                        longest: str | None = None) -> DataFrame:
    """View stream x position stream. A view lies inside its session, which ends at
    ``mark_ts``, so the conditions on it change no result."""
    points = locations.select("device_id", "kdts", "lon", "lat", "visibility")
    named = views.withColumnRenamed("device_id", "view_device_id")
    at, mark = F.col("kdts"), F.col("mark_ts")
    inside = ((F.col("view_device_id") == F.col("device_id"))
              & (F.col("start_ts") <= at) & (F.col("end_ts") >= at)
              & (mark >= at) & _reach(at, mark, longest))
    return named.join(points, inside, how)


def show_watch_live(sessions: DataFrame, shows: DataFrame, users: DataFrame, locations: DataFrame,
                    how: str = "left_outer", longest: str | None = None) -> DataFrame:
    """The whole show pipeline as one streaming query."""
    views = with_demographics_live(show_views_live(sessions, shows), users)
    return with_locations_live(views, locations, how, longest).drop("mark_ts")


def ad_view_live(ads: DataFrame, sessions: DataFrame, users: DataFrame, locations: DataFrame,
                 how: str = "left_outer", longest: str | None = None) -> DataFrame:
    """The whole ad pipeline as one streaming query."""
    views = with_demographics_live(ad_views_live(ads, sessions, longest=longest), users)
    return with_locations_live(views, locations, how, longest).drop("mark_ts")
