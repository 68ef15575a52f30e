"""Channel schedules: nested days of shows to rows with start and end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtally.functions.timecols import SHOW_DAY, SHOW_START
from airtally.operators.skew import HOT_ROWS, lead_rows


def flatten_schedule(channels: DataFrame) -> DataFrame:
    """One row per show of ``schedule: map<day, array<struct<program, program_id, start>>>``."""
    days = channels.select("channel", "channel_id", F.explode("schedule").alias("day", "shows"))
    shows = days.select("channel", "channel_id", "day", F.inline("shows"))
    start_text = F.concat_ws(" ", "day", "start")
    return shows.select(
        "program_id", "program", "channel_id", "channel", "day",
        F.to_date("day", SHOW_DAY).alias("day_date"),
        F.try_to_timestamp(start_text, F.lit(SHOW_START)).alias("start_ts"))


def schedule_end_times(shows: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """A show ends when the next one of its channel and day starts, the last at midnight."""
    led = lead_rows(shows, ["channel_id", "day"], ["start_ts", "program_id"], ["start_ts"],
                    rows=rows)
    midnight = F.date_add("day_date", 1).cast("timestamp")
    return led.select("channel_id", "channel", "program_id", "program", "day_date", "start_ts",
                      F.coalesce("next_start_ts", midnight).alias("end_ts"))


def shows_of(channels: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Shows with start and end, from the nested channel table."""
    return schedule_end_times(flatten_schedule(channels), rows)
