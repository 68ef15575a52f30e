"""Sessions, schedules, views, users, positions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.operators import enrich, schedule, sessions
from airtally.operators.dashboards import count_by
from airtally.operators.intervals import interval_overlap
from airtally.operators.skew import HOT_ROWS
from airtally.plans.registry import query
from airtally.plans.views import Views
from airtally.session import written
from airtally.sources.feeds import ads_from_topic

SHOW_COLUMNS = "program_id, program, channel_id, channel, user_id, device_id"
POINTS = "l.device_id, l.lon, l.lat, l.visibility, l.kdts"


@query("device_sessions", ["sessions"], "SELECT * FROM sessions")
def device_sessions(v: Views):
    return v.sessions()


# The test events of a user lie hours apart.
IDLE = "6 HOURS"


@query("device_sessions_open", ["actions"], """
SELECT user_id, device_id, channel_id, action_ts AS start_ts,
       coalesce(next_ts, TIMESTAMP '1970-01-01 00:00:00') AS end_ts
FROM (SELECT *, lead(action) OVER w AS next_action, lead(action_ts) OVER w AS next_ts
      FROM actions WHERE action IN (1, 2, 3)
      WINDOW w AS (PARTITION BY user_id, device_id ORDER BY action_ts, event_id))
WHERE action IN (1, 3) AND (next_action IS NULL OR next_action IN (2, 3))""")
def device_sessions_open(v: Views):
    """Sessions nobody ended are kept, as after the idle time-out."""
    return sessions.device_sessions(v.actions(), tiebreak=["event_id"], expire_open=True)


@query("device_sessions_idle", ["actions"], f"""
SELECT user_id, device_id, channel_id, action_ts AS start_ts,
       CASE WHEN next_action IS NULL OR next_ts > action_ts + INTERVAL {IDLE} THEN TIMESTAMP '1970-01-01 00:00:00'
            ELSE next_ts END AS end_ts
FROM (SELECT *, lead(action) OVER w AS next_action, lead(action_ts) OVER w AS next_ts
      FROM actions WHERE action IN (1, 2, 3)
      WINDOW w AS (PARTITION BY user_id, device_id ORDER BY action_ts, event_id))
WHERE action IN (1, 3) AND (next_action IS NULL OR next_ts > action_ts + INTERVAL {IDLE} OR next_action IN (2, 3))""")
def device_sessions_idle(v: Views):
    """Sessions nobody ends in time count as open, as the time-out on event time has it."""
    return sessions.device_sessions(v.actions(), tiebreak=["event_id"], expire_open=True, idle=IDLE)


@query("user_activity", ["numbered"], """
SELECT user_id, 0 AS part,
       string_agg(CAST(type_int AS VARCHAR), ',' ORDER BY event_ts, event_id) AS type_ints,
       coalesce(max(event_ts) FILTER (WHERE type_int < 4), TIMESTAMP '1970-01-01') AS start,
       coalesce(max(event_ts) FILTER (WHERE type_int >= 7), TIMESTAMP '1970-01-01') AS "end"
FROM numbered WHERE type_int IS NOT NULL GROUP BY user_id""")
def user_activity(v: Views):
    return whole_lists(sessions.user_activity(v.typed_events(), tiebreak=["event_id"]))


def whole_lists(days: DataFrame) -> DataFrame:
    """A row per user with the whole list as text; it is never cut, so ``part`` is 0."""
    return sessions.whole_activity(days).select(
        "user_id", F.lit(0).alias("part"), F.concat_ws(",", F.col("type_ints").cast("array<string>")).alias("type_ints"), "start", "end")


@query("type_spans", ["numbered"], """
SELECT user_id, type_int, min(event_ts) AS start,
       CASE WHEN count(*) > 1 THEN max(event_ts) ELSE TIMESTAMP '1970-01-01' END AS "end"
FROM numbered WHERE type_int IS NOT NULL GROUP BY user_id, type_int""")
def type_spans(v: Views):
    return sessions.type_spans(v.typed_events())


@query("schedule_flatten", ["flat"], "SELECT * FROM flat")
def schedule_flatten(v: Views):
    return schedule.flatten_schedule(v.channels())


@query("schedule_end_times", ["shows"], "SELECT * FROM shows")
def schedule_end_times(v: Views):
    return v.shows()


@query("show_watch_overlap", ["show_views"], f"SELECT {SHOW_COLUMNS}, start_ts, end_ts FROM show_views")
def show_watch_overlap(v: Views):
    return enrich.show_views(v.sessions_table(), v.shows_table())


@query("show_watch_overlap_plain", ["show_views"], f"SELECT {SHOW_COLUMNS}, start_ts, end_ts FROM show_views")
def show_watch_overlap_plain(v: Views):
    """The same by the bare equi-join with a range condition, for comparison."""
    return enrich.show_views(v.sessions_table(), v.shows_table(), method="plain")


@query("show_watch_crowded", ["sessions", "shows"], """
SELECT sh.program_id, sh.program, sh.channel_id, sh.channel, s.user_id, s.device_id,
       greatest(s.start_ts, sh.start_ts) AS start_ts,
       least(s.end_ts, sh.end_ts) AS end_ts
FROM (SELECT * REPLACE (CASE WHEN channel_id % 3 = 0 THEN 0 ELSE channel_id END AS channel_id) FROM sessions) s
JOIN (SELECT * REPLACE (CASE WHEN channel_id % 3 = 0 THEN 0 ELSE channel_id END AS channel_id) FROM shows) sh
  ON s.channel_id = sh.channel_id AND s.start_ts <= sh.end_ts AND s.end_ts >= sh.start_ts""")
def show_watch_crowded(v: Views):
    """Views where a third of all channels share one number; cells above 50,000 sessions are spread."""
    shared = F.when(F.col("channel_id") % 3 == 0, F.lit(0)).otherwise(F.col("channel_id"))
    crowd = [df.withColumn("channel_id", shared.cast(df.schema["channel_id"].dataType))
             for df in (v.sessions_table(), v.shows_table())]
    return enrich.show_views(*crowd, hot_rows=50_000)


@query("show_unwatched", ["sessions", "shows"], """
SELECT channel_id, program_id, program, start_ts, end_ts FROM shows sh
WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.channel_id = sh.channel_id
                  AND s.start_ts <= sh.end_ts AND s.end_ts >= sh.start_ts)""")
def show_unwatched(v: Views):
    """Shows nobody watched: the left outer join a stream cannot do."""
    pairs = interval_overlap(v.shows_table(), v.sessions_table(), "channel_id", how="left_outer")
    return pairs.filter(F.col("b_user_id").isNull()).select(
        F.col("a_channel_id").alias("channel_id"), F.col("a_program_id").alias("program_id"),
        F.col("a_program").alias("program"), "start_ts", "end_ts")


@query("ad_end_time", ["ads"], "SELECT ad_id, channel_id, start_ts, end_ts FROM ads")
def ad_end_time(v: Views):
    return ads(v)


def ads(v: Views):
    return ads_from_topic(v.ad_starts())


@query("ad_view_overlap", ["ad_views"], "SELECT * FROM ad_views")
def ad_view_overlap(v: Views):
    return enrich.ad_views(ads(v), v.sessions_table())


@query("ad_view_overlap_outer", ["ads", "sessions"], """
SELECT a.ad_id, a.channel_id, s.user_id, s.device_id,
       greatest(s.start_ts, a.start_ts) AS start_ts, least(s.end_ts, a.end_ts) AS end_ts
FROM ads a LEFT JOIN sessions s ON s.channel_id = a.channel_id
  AND s.start_ts <= a.end_ts AND s.end_ts >= a.start_ts""")
def ad_view_overlap_outer(v: Views):
    return enrich.ad_views(ads(v), v.sessions_table(), how="left_outer")


@query("show_demographic", ["show_people"],
       f"SELECT {SHOW_COLUMNS}, name, age, gender, start_ts, end_ts FROM show_people")
def show_demographic(v: Views):
    return enrich.with_demographics(enrich.show_views(v.sessions_table(), v.shows_table()), v.users(), v.hot_users())


@query("ad_demographic", ["ad_people"], "SELECT * FROM ad_people")
def ad_demographic(v: Views):
    return enrich.with_demographics(enrich.ad_views(ads(v), v.sessions_table()), v.users(), v.hot_users())


def show_views_table(v: Views):
    return written(enrich.show_views(v.sessions_table(), v.shows_table()), "show-views")


@query("show_location", ["show_views", "locations"], f"""
SELECT v.program_id, v.program, v.channel_id, v.channel, v.user_id, v.device_id AS view_device_id,
       v.start_ts, v.end_ts, {POINTS}
FROM show_views v LEFT JOIN locations l
  ON v.device_id = l.device_id AND v.start_ts <= l.kdts AND v.end_ts >= l.kdts""")
def show_location(v: Views):
    return enrich.with_locations(show_views_table(v), v.locations())


@query("ad_location", ["ad_views", "locations"], f"""
SELECT v.ad_id, v.channel_id, v.user_id, v.device_id AS view_device_id, v.start_ts, v.end_ts, {POINTS}
FROM ad_views v LEFT JOIN locations l
  ON v.device_id = l.device_id AND v.start_ts <= l.kdts AND v.end_ts >= l.kdts""")
def ad_location(v: Views):
    views = written(enrich.ad_views(ads(v), v.sessions_table()), "ad-views")
    return enrich.with_locations(views, v.locations())


@query("show_location_avg", ["show_views", "locations"], """
SELECT v.program_id, v.channel_id, v.user_id, v.device_id AS view_device_id, v.start_ts, v.end_ts,
       round(avg(l.lon), 6) AS lon, round(avg(l.lat), 6) AS lat, count(l.kdts) AS points
FROM show_views v LEFT JOIN locations l
  ON v.device_id = l.device_id AND v.start_ts <= l.kdts AND v.end_ts >= l.kdts
GROUP BY ALL""")
def show_location_avg(v: Views):
    located = enrich.with_locations(show_views_table(v), v.locations())
    view = ["program_id", "channel_id", "user_id", "view_device_id", "start_ts", "end_ts"]
    return enrich.average_location(located, view).withColumns(
        {"lon": F.round("lon", 6), "lat": F.round("lat", 6)})


@query("show_watch_full", ["show_people", "locations"], f"""
SELECT v.program_id, v.program, v.channel_id, v.channel, v.user_id, v.name, v.age, v.gender,
       v.device_id AS view_device_id, v.start_ts, v.end_ts, {POINTS}
FROM show_people v LEFT JOIN locations l
  ON v.device_id = l.device_id AND v.start_ts <= l.kdts AND v.end_ts >= l.kdts""")
def show_watch_full(v: Views):
    """Flagship: who watched which show, when, where, and who they are."""
    return enrich.show_watch_full(v.sessions_table(), v.shows_table(), v.users(), v.locations(), v.hot_users(),
                                  HOT_ROWS)


@query("ad_view_full", ["ad_people", "locations"], f"""
SELECT v.ad_id, v.channel_id, v.user_id, v.name, v.age, v.gender,
       v.device_id AS view_device_id, v.start_ts, v.end_ts, {POINTS}
FROM ad_people v LEFT JOIN locations l
  ON v.device_id = l.device_id AND v.start_ts <= l.kdts AND v.end_ts >= l.kdts""")
def ad_view_full(v: Views):
    return enrich.ad_view_full(ads(v), v.sessions_table(), v.users(), v.locations(), v.hot_users(), HOT_ROWS)


@query("event_customer_join", ["ev", "customers"], """
SELECT e.event_id, e.event_type, e.event_ts, e.event_amount, e.user_id AS customer_id,
       c.last_name, c.club_status, c.nation
FROM ev e JOIN customers c ON e.user_id = c.id""")
def event_customer_join(v: Views):
    events = v.events().select("event_id", "event_type", "event_ts", "event_amount",
                               F.col("user_id").alias("customer_id"))
    people = v.customers().select("id", "last_name", "club_status", "nation")
    return enrich.event_customer_join(events, people)


def enriched(v: Views):
    return enrich.ratings_enriched(v.ratings(), v.customer_changes(), ["version"])


@query("ratings_enriched", ["enriched"], "SELECT * FROM enriched")
def ratings_enriched(v: Views):
    return enriched(v)


@query("poor_ratings", ["ratings"], "SELECT stars, channel, message FROM ratings WHERE stars < 3")
def poor_ratings(v: Views):
    return enrich.poor_ratings(v.ratings())


@query("unhappy_premium", ["unhappy"], "SELECT * FROM unhappy")
def unhappy_premium(v: Views):
    return enrich.unhappy_premium(enriched(v), status="BUILDING")


@query("unhappy_by_name", ["unhappy"], "SELECT full_name, count(*) AS count FROM unhappy GROUP BY 1")
def unhappy_by_name(v: Views):
    return count_by(enrich.unhappy_premium(enriched(v), status="BUILDING"), "full_name")
