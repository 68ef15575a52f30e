"""Small inputs with known answers."""

from __future__ import annotations

import json
from datetime import datetime

from airtally.functions.nested import json_rows
from airtally.sources import feeds


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


# The device actions, schedules, ads, users and positions of the demo day,
# the nested sensor records and the salaries.
ACTIONS = [
    ("u45", 45, 57, 14, 1, 1612223787), ("u45", 45, 57, 14, 2, 1612223954),
    ("u45", 45, 57, 15, 1, 1612224091), ("u45", 45, 57, 15, 2, 1612224172),
    ("u46", 46, 58, 16, 1, 1612223747), ("u46", 46, 58, 16, 2, 1612223899),
    ("u46", 46, 58, 17, 1, 1612224008), ("u46", 46, 57, 17, 3, 1612224113),
    ("u46", 46, 57, 17, 2, 1612224252)]
SESSIONS = [
    (45, 14, 57, "2021-02-01 23:56:27", "2021-02-01 23:59:14"),
    (45, 15, 57, "2021-02-02 00:01:31", "2021-02-02 00:02:52"),
    (46, 16, 58, "2021-02-01 23:55:47", "2021-02-01 23:58:19"),
    (46, 17, 58, "2021-02-02 00:00:08", "2021-02-02 00:01:53"),
    (46, 17, 57, "2021-02-02 00:01:53", "2021-02-02 00:04:12")]
MORNING_SESSIONS = [
    (46, 17, 57, "2021-02-01 09:20:16", "2021-02-01 09:36:56"),
    (46, 17, 58, "2021-02-01 08:32:51", "2021-02-01 09:20:16"),
    (46, 16, 58, "2021-02-01 07:00:35", "2021-02-01 09:05:17"),
    (45, 14, 57, "2021-02-01 07:12:35", "2021-02-01 08:19:35"),
    (45, 15, 57, "2021-02-02 07:19:35", "2021-02-02 07:57:35")]


def _day(*shows):
    return [{"program": p, "program_id": i, "start": s} for p, i, s in shows]


CHANNELS = [
    {"channel": "BBC", "channel_id": 57, "schedule": {
        "01-02-2021": _day(("Animal Planet", 12, "23:55:00"), ("Living Planet", 13, "23:57:00"),
                           ("Planet Earth", 14, "23:58:00")),
        "02-02-2021": _day(("Blue Kingdom", 15, "00:00:00"), ("Wild China", 16, "00:01:00"),
                           ("Wild Africa", 17, "00:04:00"))}},
    {"channel": "HBO", "channel_id": 58, "schedule": {
        "01-02-2021": _day(("Westworld", 12, "23:55:00"), ("Wonder Woman", 13, "23:56:30"),
                           ("Dune", 14, "23:58:00")),
        "02-02-2021": _day(("Avengers", 15, "00:00:00"))}}]
MORNING_CHANNELS = [
    {"channel": "BBC", "channel_id": 57, "schedule": {
        "01-02-2021": _day(("Animal Planet", 12, "07:00:00"), ("Living Planet", 13, "07:45:00")),
        "02-02-2021": _day(("Blue Kingdom", 14, "07:00:00"), ("Wild China", 15, "08:30:00"))}},
    {"channel": "HBO", "channel_id": 58, "schedule": {
        "01-02-2021": _day(("Westworld", 12, "07:00:00"), ("Wonder Woman", 13, "07:30:00"),
                           ("Dune", 14, "09:10:00"))}}]
ADS = [
    (14, 57, "2021-02-01 23:59:39", 14), (17, 57, "2021-02-02 00:02:17", 9),
    (16, 57, "2021-02-01 23:55:19", 14), (16, 57, "2021-02-02 00:01:29", 10),
    (17, 57, "2021-02-02 00:01:08", 19)]
MORNING_ADS = [
    (17, 57, "2021-02-01 07:16:24", "2021-02-01 07:43:51"),
    (13, 58, "2021-02-01 08:19:26", "2021-02-01 08:43:18"),
    (14, 58, "2021-02-01 09:07:03", "2021-02-01 09:24:41"),
    (17, 57, "2021-02-02 07:22:27", "2021-02-02 07:24:38"),
    (18, 57, "2021-02-02 08:47:06", "2021-02-02 08:55:36")]
USERS = [(45, "u45", 55, "M"), (46, "u46", 18, "M"), (47, "u47", 51, "F")]
PLACES = {14: (-8.0, 53.0, 10000), 15: (-86.0689, 40.7537, 10000), 16: (-87.125, 39.5237, 10000),
          17: (-64.0, -34.0, 10000), 18: (-71.0, -30.0, 2518)}
PLACE_TIMES = ["2021-02-01 23:55:01", "2021-02-01 23:56:02", "2021-02-01 23:57:03",
               "2021-02-01 23:58:04", "2021-02-01 23:59:05", "2021-02-02 00:00:06",
               "2021-02-02 00:01:07", "2021-02-02 00:02:08", "2021-02-02 00:03:09"]
VIEWS = [
    (14, "Planet Earth", 57, "BBC", 45, 14, "2021-02-01 23:58:00", "2021-02-01 23:59:14"),
    (13, "Living Planet", 57, "BBC", 45, 14, "2021-02-01 23:57:00", "2021-02-01 23:58:00"),
    (12, "Animal Planet", 57, "BBC", 45, 14, "2021-02-01 23:56:27", "2021-02-01 23:57:00"),
    (16, "Wild China", 57, "BBC", 45, 15, "2021-02-02 00:01:31", "2021-02-02 00:02:52"),
    (14, "Dune", 58, "HBO", 46, 16, "2021-02-01 23:58:00", "2021-02-01 23:58:19"),
    (13, "Wonder Woman", 58, "HBO", 46, 16, "2021-02-01 23:56:30", "2021-02-01 23:58:00"),
    (12, "Westworld", 58, "HBO", 46, 16, "2021-02-01 23:55:47", "2021-02-01 23:56:30"),
    (15, "Avengers", 58, "HBO", 46, 17, "2021-02-02 00:00:08", "2021-02-02 00:01:53"),
    (17, "Wild Africa", 57, "BBC", 46, 17, "2021-02-02 00:04:00", "2021-02-02 00:04:12"),
    (16, "Wild China", 57, "BBC", 46, 17, "2021-02-02 00:01:53", "2021-02-02 00:04:00")]
NESTED = [
    {"dc_id": "666", "event_time": 1487715775521, "start_time_str": "2019-06-24 12:01:19.000",
     "readings": [2, 5, 7], "readings_array": [[2, 5], [9, 3]],
     "struct_array": [{"s": 12, "t": 19}, {"s": 17, "t": 28}],
     "source": {"sensor-igauge": {"id": 10, "ip": "68.28.91.22", "temp": [35, 2, 41]},
                "sensor-ipad": {"id": 13, "ip": "67.185.72.1", "temp": [6, 19, 4, 51]}},
     "geo": {"lat": 28.3939, "long": 16.39101}},
    {"dc_id": "777", "event_time": 1487715772911, "start_time_str": "2019-08-21 09:01:45.000",
     "readings": [2, 0, 8, 7], "readings_array": [[7, 16], [2, 8], [0, 6, 4]],
     "struct_array": [{"s": 54, "t": 37}, {"s": 42, "t": 83}],
     "source": {"sensor-igauge": {"id": 18, "ip": "68.29.12.7", "temp": [84, 2, 27, 55]},
                "sensor-ipad": {"id": 22, "ip": "67.142.71.5", "temp": [67, 66, 3, 9]}},
     "geo": {"lat": 42.3833, "long": 79.1638}}]
SALARIES = [
    (7369, 800, 10), (7499, 1600, 30), (7521, 1250, 30), (7566, 2975, 20), (7654, 1250, 30),
    (7698, 2850, 30), (7782, 2450, 10), (7788, 3000, 20), (7839, 5000, 10), (7844, 1500, 30),
    (7876, 1100, 20)]


def actions(spark):
    df = spark.createDataFrame(ACTIONS, "user string, user_id int, channel_id int, device_id int, "
                                        "action int, secs long")
    return df.selectExpr("user", "user_id", "channel_id", "device_id", "action",
                         "timestamp_seconds(secs) AS action_ts")


def _timed(spark, data, schema, *names):
    df = spark.createDataFrame(data, schema)
    return df.withColumns({n: df[n].cast("timestamp") for n in names})


def sessions(spark, data=None):
    return _timed(spark, data or SESSIONS, "user_id int, device_id int, channel_id int, "
                  "start_ts string, end_ts string", "start_ts", "end_ts")


def ads(spark):
    started = _timed(spark, ADS, "ad_id int, channel_id int, start_ts string, duration_secs int", "start_ts")
    return feeds.ads_from_topic(started)


def morning_ads(spark):
    return _timed(spark, MORNING_ADS, "ad_id int, channel_id int, start_ts string, end_ts string",
                  "start_ts", "end_ts")


def users(spark):
    return spark.createDataFrame(USERS, "user_id int, name string, age int, gender string")


def channels(spark, data=None):
    return json_rows(spark, json.dumps(data or CHANNELS), feeds.CHANNEL)


def locations(spark):
    data = [(d, t, *p) for t in PLACE_TIMES for d, p in PLACES.items()]
    return _timed(spark, data, "device_id int, kdts string, lon float, lat float, visibility int", "kdts")
