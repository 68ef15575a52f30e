"""Watching sessions and user activity from raw events, in closed batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.functions.values import type_number
from airtally.operators.skew import HOT_ROWS, lead_rows

# The action codes of the device feed.
START, STOP, SWITCH = 1, 2, 3
# Event types below START_BELOW open an activity, from END_FROM on close it.
START_BELOW, END_FROM = 4, 7


def device_sessions(actions: DataFrame, tiebreak: list[str] | None = None,
                    expire_open: bool = False, rows: int = HOT_ROWS, idle: str | None = None) -> DataFrame:
    """One row per finished watching session of a (user, device).

    A start or switch opens a session on its channel and the next action ends it
    if that action is a stop or a switch; another start discards the open one.
    With ``expire_open`` a session nobody ended is kept with end = epoch 0. With ``idle``
    (an interval such as ``90 seconds``) an action that comes later than that ends nothing:
    the session before it is one that nobody ended.
    """
    known = actions.filter(F.col("action").isin(START, STOP, SWITCH)
                           & F.col("action_ts").isNotNull())
    paired = lead_rows(known, ["user_id", "device_id"], ["action_ts", *(tiebreak or [])],
                       ["action", "action_ts"], rows=rows)
    if idle is not None:
        late = F.col("next_action_ts") > F.col("action_ts") + F.expr(f"INTERVAL {idle}")
        paired = paired.withColumns({c: F.when(~late, F.col(c)) for c in ("next_action", "next_action_ts")})
    ended = F.col("next_action").isin(STOP, SWITCH)
    keep = ended | F.col("next_action").isNull() if expire_open else ended
    kind = actions.schema["action_ts"].dataType
    return paired.filter(F.col("action").isin(START, SWITCH) & keep).select(
        "user_id", "device_id", "channel_id",
        F.col("action_ts").alias("start_ts"),
        F.coalesce("next_action_ts", F.timestamp_micros(F.lit(0)).cast(kind)).alias("end_ts"))


def _typed(events: DataFrame) -> DataFrame:
    """Events with a time and a numbered type; others never reach the state."""
    return (events.withColumn("type_int", type_number(F.col("event_type")))
            .filter(F.col("event_ts").isNotNull() & F.col("type_int").isNotNull()))


def _epoch(events: DataFrame):
    return F.timestamp_micros(F.lit(0)).cast(events.schema["event_ts"].dataType)


def _bounds(events: DataFrame) -> list:
    """Latest opening and latest closing event, epoch 0 where there is none."""
    opened = F.max(F.when(F.col("type_int") < START_BELOW, F.col("event_ts")))
    closed = F.max(F.when(F.col("type_int") >= END_FROM, F.col("event_ts")))
    return [F.coalesce(opened, _epoch(events)).alias("start"),
            F.coalesce(closed, _epoch(events)).alias("end")]


def user_activity(events: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """Per user and calendar day: the numbers of all event types in time order, and the
    day's latest opening and closing time.

    A day's list is whole. Days divide a user's list by a rule of the data, so its shape does
    not depend on how many events there are, and no list grows with the years.
    """
    order = ["event_ts", *(tiebreak or []), "type_int"]
    types = F.transform(F.sort_array(F.collect_list(F.struct(*order))), lambda e: e["type_int"])
    return (_typed(events).groupBy("user_id", F.to_date("event_ts").alias("day"))
            .agg(types.alias("type_ints"), *_bounds(events)))


def whole_activity(days: DataFrame) -> DataFrame:
    """Per user: the whole list of ``user_activity``, its days in order, and the latest opening and closing time.

    Days are made in tasks of their own and carry type numbers only, so a heavy user's events are
    never sorted in one task.
    """
    in_order = F.sort_array(F.collect_list(F.struct("day", "type_ints")))
    none = F.timestamp_micros(F.lit(0)).cast(days.schema["start"].dataType)

    def latest(bound: str):
        # Epoch 0 stands for none, so a time before it counts where the other days have none.
        return F.coalesce(F.max(F.when(F.col(bound) != none, F.col(bound))), none).alias(bound)

    return days.groupBy("user_id").agg(F.flatten(F.transform(in_order, lambda d: d["type_ints"])).alias("type_ints"),
                                       latest("start"), latest("end"))


def type_spans(events: DataFrame) -> DataFrame:
    """Per user and event type: first time, and last time if it came more than once."""
    return (_typed(events).groupBy("user_id", "type_int")
            .agg(F.min("event_ts").alias("start"),
                 F.when(F.count(F.lit(1)) > 1, F.max("event_ts"))
                 .otherwise(_epoch(events)).alias("end")))
