"""Who watched what: views of shows and ads, with user and location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.functions.values import full_name
from airtally.operators.changes import latest_by_key
from airtally.operators.intervals import interval_overlap, point_in_interval
from airtally.operators.skew import HOT_ROWS, hot_keys, salted_join
from airtally.session import written


def show_views(sessions: DataFrame, shows: DataFrame, method: str = "cells",
               hot_rows: int | None = None) -> DataFrame:
    """The part of every session that fell into a show of its channel.

    ``hot_rows`` spreads cells with more sessions than that, after counting them.
    """
    pairs = interval_overlap(sessions, shows, "channel_id", method=method, hot_rows=hot_rows)
    return pairs.select(
        F.col("b_program_id").alias("program_id"), F.col("b_program").alias("program"),
        F.col("b_channel_id").alias("channel_id"), F.col("b_channel").alias("channel"),
        F.col("a_user_id").alias("user_id"), F.col("a_device_id").alias("device_id"),
        "start_ts", "end_ts")


def ad_views(ads: DataFrame, sessions: DataFrame, how: str = "inner", method: str = "cells",
             hot_rows: int | None = None) -> DataFrame:
    """The part of every session that fell into an ad; ``left_outer`` keeps unseen ads.

    ``hot_rows`` as in ``show_views``. Sessions are many and ads few, so an inner join has the
    sessions on the side that is spread.
    """
    if how == "inner":
        ad, session = "b_", "a_"
        pairs = interval_overlap(sessions, ads, "channel_id", method=method, hot_rows=hot_rows)
    else:
        ad, session = "a_", "b_"
        pairs = interval_overlap(ads, sessions, "channel_id", how=how, method=method, hot_rows=hot_rows)
    return pairs.select(
        F.col(f"{ad}ad_id").alias("ad_id"), F.col(f"{ad}channel_id").alias("channel_id"),
        F.col(f"{session}user_id").alias("user_id"), F.col(f"{session}device_id").alias("device_id"),
        "start_ts", "end_ts")


def with_demographics(views: DataFrame, users: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Add name, age and gender of the viewer; views of unknown users go.

    The size of ``users`` is not known here, so Spark chooses the join from its
    statistics. ``hot`` (see ``hot_keys``) spreads users with very many views.
    """
    people = users.select("user_id", "name", "age", "gender")
    if hot is None:
        return views.join(people, "user_id")
    return salted_join(views, people, ["user_id"], hot=hot)


def with_locations(views: DataFrame, locations: DataFrame, how: str = "left_outer",
                   method: str = "cells", hot_rows: int | None = None) -> DataFrame:
    """Add the device's positions during the view; ``device_id`` is the one of the
    position, so it is null where there was none, and ``view_device_id`` stays.
    ``hot_rows`` spreads cells with more views than that, after counting them."""
    points = locations.select("device_id", "kdts", "lon", "lat", "visibility")
    return point_in_interval(views, points, "device_id", how=how, method=method, hot_rows=hot_rows)


def average_location(located: DataFrame, view_columns: list[str]) -> DataFrame:
    """One row per view: mean position over the points matched to it."""
    return located.groupBy(*view_columns).agg(
        F.avg("lon").alias("lon"), F.avg("lat").alias("lat"),
        F.count("kdts").alias("points"))


def show_watch_full(sessions: DataFrame, shows: DataFrame, users: DataFrame,
                    locations: DataFrame, hot_users: DataFrame | None = None,
                    hot_rows: int | None = None) -> DataFrame:
    """Sessions x shows, with viewer and position.

    ``hot_rows`` spreads crowded cells in both interval joins. The location join reads the views more than once, so they are written first.
    ``sessions`` and ``shows`` should be tables for the same reason.
    """
    views = with_demographics(show_views(sessions, shows, hot_rows=hot_rows), users, hot_users)
    return with_locations(written(views, "show-views"), locations, hot_rows=hot_rows)


def ad_view_full(ads: DataFrame, sessions: DataFrame, users: DataFrame,
                 locations: DataFrame, hot_users: DataFrame | None = None,
                 hot_rows: int | None = None) -> DataFrame:
    """Ads x sessions, with viewer and position; see ``show_watch_full``."""
    views = with_demographics(ad_views(ads, sessions, hot_rows=hot_rows), users, hot_users)
    return with_locations(written(views, "ad-views"), locations, hot_rows=hot_rows)


def event_customer_join(events: DataFrame, customers: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Events with the row of their customer; events of unknown customers go."""
    known = customers.withColumnRenamed("id", "customer_id")
    return salted_join(events, known, ["customer_id"],
                       hot=hot_keys(events, ["customer_id"], rows))


def ratings_enriched(ratings: DataFrame, customer_changes: DataFrame, order: list[str],
                     rows: int = HOT_ROWS) -> DataFrame:
    """Ratings with the latest state of their customer, where a first name is known."""
    return with_customers(ratings, latest_by_key(customer_changes, ["id"], order), rows)


def with_customers(ratings: DataFrame, customers: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Ratings with their customer from a table of one row each, where a first name is known."""
    people = customers.select(F.col("id").alias("user_id"), "first_name", "last_name",
                          "club_status", "email")
    joined = salted_join(ratings, people, ["user_id"], "left",
                         hot=hot_keys(ratings, ["user_id"], rows))
    return joined.filter(F.col("first_name").isNotNull()).select(
        "rating_id", "message", "stars", "channel", F.col("user_id").alias("id"),
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "club_status", "email", *[c for c in ("rated_ts",) if c in ratings.columns])


def poor_ratings(ratings: DataFrame, below: int = 3) -> DataFrame:
    """Ratings under ``below`` stars."""
    return ratings.filter(F.col("stars") < below).select("stars", "channel", "message")


def unhappy_premium(enriched: DataFrame, status: str = "platinum", below: int = 3) -> DataFrame:
    """Poor ratings given by customers of one club status."""
    return enriched.filter((F.col("stars") < below) & (F.col("club_status") == status)).select(
        "full_name", "club_status", "email", "stars", "message")
