"""Streams: batch answers, restarts, late rows, time-outs, sinks."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F
from samples import (SESSIONS, VIEWS, actions, ads, at, channels, locations, rows, sessions, users)

from airtally.operators import enrich, schedule
from airtally.operators.dashboards import count_by
from airtally.operators.sessions import device_sessions, user_activity
from airtally.sources import documents, feeds, files, topics
from airtally.streaming import joins, latest, state
from airtally.streaming.runner import ALL_THERE_IS, Live, kept, run_queries, table_sink


def timed(data):
    return sorted(((*r[:-2], at(r[-2]), at(r[-1])) for r in data), key=repr)


def drop_files(df, folder, groups, column):
    """Write ``df`` as one Parquet file per listed group of values, oldest first."""
    for group in groups:
        df.filter(F.col(column).isin(group)).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)


def stream_of(spark, df, folder):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def finish(live, folder, keys=None):
    table_sink(live, str(folder)).awaitTermination()
    return kept(live, str(folder), keys)


def test_sessions_over_batches_and_a_restart(spark, tmp_path):
    acts = actions(spark)
    drop_files(acts, tmp_path / "in", [[1]], "action")
    live = Live("s", state.device_sessions_stream(stream_of(spark, acts, tmp_path / "in"),
                                                  clock=state.NEVER), "update")
    assert finish(live, tmp_path / "out").count() == 0
    drop_files(acts, tmp_path / "in", [[3], [2]], "action")
    # A new run from the same checkpoint finds the open sessions.
    assert rows(finish(live, tmp_path / "out")) == timed(SESSIONS)


def test_idle_session_is_closed_by_event_time(spark, tmp_path):
    acts = actions(spark)
    late = acts.filter("device_id = 14").withColumns(
        {"action": F.lit(0), "action_ts": F.col("action_ts") + F.expr("INTERVAL 1 DAY"),
         "device_id": F.lit(99)})
    drop_files(acts.filter("action = 1 AND device_id = 14"), tmp_path / "in", [[1]], "action")
    drop_files(late, tmp_path / "in", [[0]], "action")
    marked = stream_of(spark, acts, tmp_path / "in").withWatermark("action_ts", "1 second")
    live = Live("s", state.device_sessions_stream(marked, mode="append", clock=state.EVENT))
    got = finish(live, tmp_path / "out").collect()
    assert [(r.user_id, r.device_id, r.start_ts, r.end_ts) for r in got] \
        == [(45, 14, at("2021-02-01 23:56:27"), at("1970-01-01 00:00:00"))]


def test_activity_and_spans_are_closed_by_event_time(spark, tmp_path):
    data = [(1, "2024-01-01 00:00:00", "type_2"), (1, "2024-01-01 00:00:05", "type_8"),
            (1, "2024-01-01 00:00:06", "type_8"), (1, None, "type_1"), (1, "2024-01-01 00:00:07", "type_"),
            (2, "2024-01-02 00:00:00", "type_5")]
    df = spark.createDataFrame(data, "user_id int, t string, event_type string").select(
        "user_id", F.col("t").cast("timestamp").alias("event_ts"), "event_type")
    drop_files(df, tmp_path / "in", [[1], [2]], "user_id")
    marked = stream_of(spark, df, tmp_path / "in").withWatermark("event_ts", "1 second")
    sent = finish(Live("a", state.activity_parts_stream(marked, clock=state.EVENT)), tmp_path / "out")
    assert sorted((r.part, r.type_ints) for r in sent.filter("user_id = 1").collect()) == [(0, [2, 8, 8]), (1, [500])]
    closed = state.activity_days(sent).filter("user_id = 1").first()
    assert closed.type_ints == [2, 8, 8, 500]
    assert (closed.start, closed.end) == (at("2024-01-01 00:00:00"), at("2024-01-01 00:00:06"))
    spans = finish(Live("b", state.type_spans_stream(marked, clock=state.EVENT)), tmp_path / "out")
    assert rows(spans.filter("user_id = 1")) == [
        (1, 2, at("2024-01-01 00:00:00"), at("1970-01-01 00:00:00")),
        (1, 8, at("2024-01-01 00:00:05"), at("2024-01-01 00:00:06")),
        (1, 999, at("1970-01-01 00:00:00"), at("1970-01-01 00:00:00"))]


def test_activity_sends_each_event_once(spark, tmp_path):
    """Lists that grow over many micro-batches: rows sent on are those that came in."""
    df = spark.range(120).select(
        (F.col("id") % 2).cast("int").alias("user_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704067200 - 60) + F.col("id")).alias("event_ts"),
        F.concat(F.lit("type_"), F.col("id") % 9).alias("event_type"), (F.col("id") / 30).cast("int").alias("batch"))
    drop_files(df, tmp_path / "in", [[0], [1], [2], [3]], "batch")
    found = state.activity_parts_stream(stream_of(spark, df, tmp_path / "in"), tiebreak="event_id", clock=state.NEVER)
    sent = finish(Live("a", found), tmp_path / "out")
    assert sent.agg(F.sum(F.size("type_ints"))).first()[0] == 120
    whole = user_activity(df, ["event_id"]).collect()
    assert {(r.user_id, r.day): (r.type_ints, r.start, r.end) for r in state.activity_days(sent).collect()} \
        == {(r.user_id, r.day): (r.type_ints, r.start, r.end) for r in whole} and len(whole) == 4


def test_state_takes_nulls_and_large_numbers(spark, tmp_path):
    """Null channels, times and actions, and ids that a double cannot hold."""
    big = (1 << 62) + 1
    data = [(1, 1, None, 1, "2024-01-01 00:00:00", 1), (1, 1, big, 3, "2024-01-01 00:01:00", big + 1),
            (1, 1, 5, 3, "2024-01-01 00:01:00", big + 2), (1, 1, 6, None, "2024-01-01 00:02:00", 3),
            (1, 1, 7, 2, None, 4), (1, 1, None, 2, "2024-01-01 00:03:00", None)]
    acts = spark.createDataFrame(data, "user_id int, device_id int, channel_id bigint, action int, t string, tie bigint") \
        .withColumn("action_ts", F.to_timestamp("t")).drop("t")
    acts.coalesce(1).write.parquet(str(tmp_path / "in"))
    found = state.device_sessions_stream(stream_of(spark, acts, tmp_path / "in"), tiebreak="tie", clock=state.NEVER, mode="append")
    got = finish(Live("s", found), tmp_path / "out").orderBy("start_ts", "end_ts", F.col("channel_id").isNull()).collect()
    minute = [at(f"2024-01-01 00:0{m}:00") for m in range(4)]
    assert [(r.channel_id, r.start_ts, r.end_ts) for r in got] == [
        (None, minute[0], minute[1]), (big, minute[1], minute[1]), (5, minute[1], minute[3])]


def test_latest_table_over_batches(spark, tmp_path):
    """Late and repeated changes, a restart, merged versions and what is left of old ones."""
    data = [(0, 1, 5, "a"), (0, 2, 1, "b"), (1, 1, 4, "late"), (1, 2, 2, "c"), (2, 2, 2, "c"), (3, 3, 1, None),
            (4, None, 1, "n"), (5, 1, 9, "z"), (6, None, 2, "m"), (6, 4, 1, "d")]
    df = spark.createDataFrame(data, "batch int, k int, v int, t string")
    folder, want = str(tmp_path / "out"), {}
    assert latest.latest_table(spark, folder, df.schema, ["k"], ["v"]).count() == 0
    for group in ([0, 1, 2], [3, 4, 5, 6]):
        drop_files(df, tmp_path / "in", [[b] for b in group], "batch")
        latest.keep_latest(stream_of(spark, df, tmp_path / "in"), folder, ["k"], ["v"], merge_every=2).awaitTermination()
        for _, k, v, t in (r for r in data if r[0] in group):
            want[k] = max(want.get(k, (v, t)), (v, t), key=lambda r: r[0])
        got = latest.latest_table(spark, folder, df.schema, ["k"], ["v"]).collect()
        assert {r.k: (r.v, r.t) for r in got} == want and len(got) == len(want)
    assert latest._complete(spark, folder, latest.VERSION) == [3, 5]
    assert latest._complete(spark, folder, latest.DELTA) == [4, 5, 6]
    # A batch that ran again after a failure sees only what came before it.
    past = latest.latest_table(spark, folder, df.schema, ["k"], ["v"], before=4).collect()
    assert {r.k: (r.v, r.t) for r in past} == {1: (5, "a"), 2: (2, "c"), 3: (1, None)}


def test_heavy_customer_on_a_stream(spark, tmp_path):
    """A micro-batch's heavy key is spread, and rows of unknown customers go."""
    events = spark.range(300).select("id", F.when(F.col("id") < 200, 7).otherwise(F.col("id")).cast("int").alias("customer_id"))
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    people = spark.createDataFrame([(7, "seven"), (250, "other")], "id int, name string")
    seen = []

    def step(batch):
        joined = enrich.event_customer_join(batch.withColumnRenamed("id", "event_id"), people, rows=50)
        seen.append("slice" in joined._jdf.queryExecution().optimizedPlan().toString())
        return joined
    got = finish(Live("j", stream_of(spark, events, tmp_path / "in"), step=step), tmp_path / "out")
    assert got.count() == 201 and got.filter("name = 'seven'").count() == 200
    assert any(seen)


def test_sessions_on_the_clock(spark, tmp_path):
    """With a processing-time timer the quiet session is closed while the query runs."""
    acts = actions(spark).filter("action = 1 AND device_id IN (14, 16)")
    drop_files(acts, tmp_path / "in", [[1]], "action")
    found = state.device_sessions_stream(stream_of(spark, acts, tmp_path / "in"), idle_ms=1000)
    live = Live("s", found, "update", {"processingTime": "1 second"})
    query = table_sink(live, str(tmp_path / "out"))
    try:
        for _ in range(60):
            time.sleep(1)
            assert query.exception() is None
            if (tmp_path / "out/s/rows").exists() and kept(live, str(tmp_path / "out")).count() == 2:
                break
    finally:
        query.stop()
    assert {r.end_ts for r in kept(live, str(tmp_path / "out")).collect()} == {at("1970-01-01 00:00:00")}


def test_show_pipeline_matches_batch(spark, tmp_path):
    sess, places = sessions(spark), locations(spark)
    drop_files(sess, tmp_path / "s", [[57, 58]], "channel_id")
    drop_files(places, tmp_path / "p", [[14, 15, 16, 17, 18]], "device_id")
    later = sess.limit(1).withColumns({c: F.col(c) + F.expr("INTERVAL 2 DAYS") for c in ("start_ts", "end_ts")})
    moved = places.limit(1).withColumn("kdts", F.col("kdts") + F.expr("INTERVAL 2 DAYS"))
    for n in (1, 2):  # later batches move the watermark, so unmatched rows come out
        time.sleep(0.05)
        later.withColumn("channel_id", F.lit(1000 + n)).coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
        moved.withColumn("device_id", F.lit(1000 + n)).coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    marked = stream_of(spark, sess, tmp_path / "s").withWatermark("end_ts", feeds.LATE["view"])
    points = stream_of(spark, places, tmp_path / "p").withWatermark("kdts", feeds.LATE["location"])
    shows = schedule.shows_of(channels(spark))
    got = finish(Live("w", joins.show_watch_live(marked, shows, users(spark), points)), tmp_path / "out")
    assert got.filter("kdts IS NOT NULL").count() == 10
    assert rows(got.filter("kdts IS NULL"), "program", "view_device_id", "device_id") \
        == [("Animal Planet", 14, None), ("Wild Africa", 17, None)]
    assert rows(got.select("program_id", "program", "channel_id", "channel", "user_id",
                           F.col("view_device_id").alias("d"), "start_ts", "end_ts").distinct()) == timed(VIEWS)


def test_ad_pipeline_and_unseen_ads(spark, tmp_path):
    sess, shown = sessions(spark), ads(spark)
    drop_files(sess, tmp_path / "s", [[57, 58]], "channel_id")
    drop_files(shown, tmp_path / "a", [[14, 16, 17]], "ad_id")
    later = {c: F.col(c) + F.expr("INTERVAL 2 DAYS") for c in ("start_ts", "end_ts")}
    for n in (1, 2):
        time.sleep(0.05)
        for df, name in ((sess, "s"), (shown, "a")):
            (df.limit(1).withColumns(later).withColumn("channel_id", F.lit(1000 + n) if name == "s" else F.lit(2000 + n))
             .coalesce(1).write.mode("append").parquet(str(tmp_path / name)))
    marked = stream_of(spark, sess, tmp_path / "s").withWatermark("end_ts", feeds.LATE["session"])
    adverts = stream_of(spark, shown, tmp_path / "a").withWatermark("start_ts", feeds.LATE["ad"])
    got = finish(Live("a", joins.ad_views_live(adverts, marked, "left_outer", "24 hours")), tmp_path / "out")
    night = got.filter("channel_id < 1000")
    assert night.filter("user_id IS NOT NULL").count() == 3
    assert night.filter("user_id IS NULL").count() == 3
    places = locations(spark)
    drop_files(places, tmp_path / "p", [[14, 15, 16, 17, 18]], "device_id")
    points = stream_of(spark, places, tmp_path / "p").withWatermark("kdts", feeds.LATE["location"])
    full = joins.ad_view_live(adverts, marked, users(spark), points, "inner")
    assert finish(Live("f", full), tmp_path / "out").count() == 0


def test_a_long_view_waits_for_its_points(spark, tmp_path):
    """The watermark passes the start of a view long before its last point comes."""
    def put(name, data, schema, *times):
        df = spark.createDataFrame(data, schema)
        df = df.withColumns({t: F.concat(F.lit("2024-01-01 "), t).cast("timestamp") for t in times})
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        time.sleep(0.05)
        return df
    sess = [(1, 1, 5, "00:00:00", "10:00:00"), (2, 2, 5, "05:00:00", "05:10:00"),
            (2, 2, 5, "08:30:00", "08:40:00"), (2, 2, 5, "23:30:00", "23:40:00"), (2, 2, 5, "23:31:00", "23:41:00")]
    dots = [(1, "00:30:00"), (9, "05:00:00"), (1, "08:30:00"), (9, "23:30:00"), (9, "23:40:00")]
    advert = [(1, 5, "00:10:00", "09:00:00"), (2, 6, "05:00:00", "05:01:00"), (2, 6, "08:30:00", "08:31:00"),
              (2, 6, "23:30:00", "23:31:00"), (2, 6, "23:31:00", "23:32:00")]
    for s, d, a in zip(sess, dots, advert):
        sdf = put("s", [s], "user_id int, device_id int, channel_id int, start_ts string, end_ts string",
                  "start_ts", "end_ts")
        pdf = put("p", [(*d, 0.0, 0.0, 1)], "device_id int, kdts string, lon double, lat double, visibility int", "kdts")
        adf = put("a", [a], "ad_id int, channel_id int, start_ts string, end_ts string", "start_ts", "end_ts")
    shows = spark.sql("SELECT 5 AS channel_id, 'c' AS channel, 1 AS program_id, 'p' AS program, "
                      "timestamp'2024-01-01 00:00:00' AS start_ts, timestamp'2024-01-02 00:00:00' AS end_ts")
    people = spark.createDataFrame([(1, "a", 1, "M"), (2, "b", 1, "F")], "user_id int, name string, age int, gender string")
    flow = stream_of(spark, sdf, tmp_path / "s").withWatermark("end_ts", "90 seconds")
    points = stream_of(spark, pdf, tmp_path / "p").withWatermark("kdts", "60 seconds")
    got = finish(Live("w", joins.show_watch_live(flow, shows, people, points, longest="11 hours")), tmp_path / "out")
    assert rows(got.filter("user_id = 1"), "kdts") == [(at("2024-01-01 00:30:00"),), (at("2024-01-01 08:30:00"),)]
    assert got.filter("user_id = 2 AND kdts IS NULL").count() >= 2
    adverts = stream_of(spark, adf, tmp_path / "a").withWatermark("start_ts", "60 seconds")
    views = finish(Live("a", joins.ad_views_live(adverts, flow, longest="20 hours")), tmp_path / "out")
    # The long ad also meets the sessions that came after the watermark had passed it.
    assert rows(views.filter("ad_id = 1"), "user_id", "start_ts") == [
        (1, at("2024-01-01 00:10:00")), (2, at("2024-01-01 05:00:00")), (2, at("2024-01-01 08:30:00"))]


def test_a_session_of_thirty_hours_meets_its_early_ad(spark, tmp_path):
    """No bound holds by default; a bound given by the caller does."""
    days = [("2024-01-01 00:00:00", "2024-01-02 06:00:00"), ("2024-01-03 00:00:00", "2024-01-03 01:00:00")]
    shown = [("2024-01-01 02:00:00", "2024-01-01 02:01:00"), ("2024-01-02 12:00:00", "2024-01-02 12:01:00")]
    times = {t: F.col(t).cast("timestamp") for t in ("start_ts", "end_ts")}
    sess = spark.createDataFrame([(1, 1, 5, *d) for d in days],
                                 "user_id int, device_id int, channel_id int, start_ts string, end_ts string").withColumns(times)
    adverts = spark.createDataFrame([(n, 5, *d) for n, d in enumerate(shown)],
                                    "ad_id int, channel_id int, start_ts string, end_ts string").withColumns(times)
    drop_files(adverts, tmp_path / "a", [[0], [1]], "ad_id")
    for n in (0, 1):  # the ads' watermark passes the first ad long before the session ends
        sess.filter(F.col("start_ts") == days[n][0]).coalesce(1).write.mode("append").parquet(str(tmp_path / "s"))
        time.sleep(0.05)
    flow = stream_of(spark, sess, tmp_path / "s").withWatermark("end_ts", "60 seconds")
    ads_in = stream_of(spark, adverts, tmp_path / "a").withWatermark("start_ts", "60 seconds")
    for name, longest, found in (("free", None, [(0,)]), ("bound", "24 hours", [])):
        views = finish(Live(name, joins.ad_views_live(ads_in, flow, longest=longest)), tmp_path / "out")
        assert rows(views, "ad_id") == found
    with pytest.raises(ValueError):
        joins.ad_views_live(ads_in, flow, "left_outer")


def test_late_rows_are_dropped(spark, tmp_path):
    data = [(1, "2024-01-01 00:00:01"), (2, "2024-01-01 01:00:00"), (3, "2024-01-01 02:00:00"),
            (4, "2024-01-01 00:00:02"), (5, "2024-01-01 03:00:00")]
    df = spark.createDataFrame(data, "n int, t string").select("n", F.col("t").cast("timestamp").alias("ts"))
    drop_files(df, tmp_path / "in", [[1], [2], [3], [4], [5]], "n")
    counted = (stream_of(spark, df, tmp_path / "in").withWatermark("ts", "5 seconds")
               .groupBy(F.window("ts", "10 seconds")).count().select("window.start", "count"))
    got = rows(finish(Live("c", counted), tmp_path / "out"))
    # Row 4 comes after its window was given out.
    assert got == [(at(f"2024-01-01 0{h}:00:00"), 1) for h in range(3)]


def test_complete_and_update_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "a")], "n int, name string")
    drop_files(df, tmp_path / "in", [[1], [2], [3]], "n")
    counted = count_by(stream_of(spark, df, tmp_path / "in"), "name")
    for mode, keys in (("complete", None), ("update", ["name"])):
        assert rows(finish(Live(mode, counted, mode), tmp_path / "out", keys)) == [("a", 3), ("b", 1)]


def write_lines(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))


def test_feeds_from_files_and_topics(spark, tmp_path):
    folder = tmp_path / "files"
    write_lines(folder / "session1.json", {"user_id": 46, "device_id": 17, "channel_id": 57,
                                           "start_ts": 1612171216, "end_ts": 1612172216})
    write_lines(folder / "ad1.json", {"ad_id": 17, "channel_id": 57, "start_ts": 1612163784, "end_ts": 1612165431})
    write_lines(folder / "user1.json", {"user_id": 45, "name": "u45", "age": 55, "gender": "M"})
    write_lines(folder / "device_loc1.json", {"device_id": 14, "name": "Brazil", "visibility": 5534,
                                              "coord": {"lon": 37.25, "lat": 21.5}})
    write_lines(folder / "action1.json", {"user": "u45", "user_id": 45, "channel_id": 57, "device_id": 14,
                                          "action": 1, "action_ts": 1612223787})
    still = feeds.Feeds(spark, str(folder), from_topics=False, stream=False)
    assert rows(still.sessions(), "start_ts") == [(at("2021-02-01 09:20:16"),)]
    assert rows(still.locations()) == [(14, "Brazil", 5534, 37.25, 21.5)]
    assert rows(still.actions(), "action_ts") == [(at("2021-02-01 23:56:27"),)]
    flowing = feeds.Feeds(spark, str(folder), from_topics=False)
    assert flowing.sessions().isStreaming and flowing.ads().isStreaming
    got = finish(Live("u", flowing.users()), tmp_path / "out")
    assert rows(got) == [(45, "u45", 55, "M")]

    bus = str(tmp_path / "bus")
    iso = "date_format(start_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\") AS start"
    topics.write_topic(sessions(spark).selectExpr("user_id", "device_id", "channel_id", iso,
                                                  iso.replace("start", "end").replace("end_ts", "end_ts")),
                       bus, "session", key="user_id")
    topics.write_topic(spark.sql("SELECT 17 AS ad_id, 57 AS channel_id, timestamp'2021-02-01 00:00:00' AS start_ts, "
                                 "9 AS duration_secs"), bus, "ad")
    topics.write_topic(spark.sql("SELECT 45 AS ID, 'u45' AS user_name, 55 AS age, 'M' AS gender"), bus, "user", key="ID")
    for stream in (False, True):
        feed = feeds.Feeds(spark, bus, stream=stream)
        if stream:
            assert rows(finish(Live("s", feed.sessions()), tmp_path / "out2")) == timed(SESSIONS)
        else:
            assert rows(feed.sessions()) == timed(SESSIONS)
            assert rows(feed.ads(), "end_ts") == [(at("2021-02-01 00:00:09"),)]
            assert rows(feed.users()) == [(45, "u45", 55, "M")]


def test_topic_sink_and_echo(spark, tmp_path):
    acts = actions(spark)
    drop_files(acts, tmp_path / "in", [[1], [2], [3]], "action")
    bus = str(tmp_path / "bus")
    query = topics.topic_sink(stream_of(spark, acts, tmp_path / "in"), bus, "action", "append",
                              str(tmp_path / "cp"), key="user_id", trigger=ALL_THERE_IS)
    query.awaitTermination()
    back = feeds.Feeds(spark, bus, stream=False).actions()
    assert rows(device_sessions(back)) == timed(SESSIONS)
    messages = topics.topic_source(spark, bus, "action", stream=False)
    # Only a broker numbers messages.
    assert messages.filter("offset IS NULL AND partition IS NULL").count() == 9
    assert {bytes(r.key) for r in messages.collect()} == {b"45", b"46"}
    with pytest.raises(ValueError):
        topics.topic_source(spark, "kafka:broker", "action", offset=5)


def test_views_saved_between_steps(spark, tmp_path):
    shows = schedule.shows_of(channels(spark))
    views = enrich.with_demographics(enrich.show_views(sessions(spark), shows), users(spark))
    topics.write_topic(views, str(tmp_path), "views", key="user_id")
    back = feeds.views_from_topic(topics.topic_decode(
        topics.topic_source(spark, str(tmp_path), "views", stream=False), feeds.SHOW_VIEW))
    assert rows(back, *sorted(back.columns)) == rows(views, *sorted(views.columns))


def test_file_index_and_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Films", "a"), ("Books", "b")], "topic string, title string")
    drop_files(df, tmp_path / "in", [["Films"], ["Books"]], "topic")
    flow = stream_of(spark, df, tmp_path / "in")
    files.json_sink(flow, str(tmp_path / "json"), str(tmp_path / "c1"), files=1, trigger=ALL_THERE_IS).awaitTermination()
    assert rows(spark.read.json(str(tmp_path / "json")), "topic", "title") == rows(df)
    files.text_sink(flow.select("title"), str(tmp_path / "text"), str(tmp_path / "c2"),
                    trigger=ALL_THERE_IS).awaitTermination()
    assert rows(files.text_lines(spark, str(tmp_path / "text"))) == [("a",), ("b",)]
    echo = files.text_lines(spark, str(tmp_path / "text"), stream=True)
    files.memory_sink(echo, "lines_mem", trigger=ALL_THERE_IS).awaitTermination()
    assert spark.sql("SELECT count(*) FROM lines_mem").first()[0] == 2
    files.parquet_sink(flow, str(tmp_path / "pq"), str(tmp_path / "c3"), trigger=ALL_THERE_IS).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 2
    documents.index_sink(flow, F.col("topic"), str(tmp_path / "index"), str(tmp_path / "c4"),
                         names={"Films": "cinema"}, trigger=ALL_THERE_IS).awaitTermination()
    indexed = [json.loads(r.value)["title"] for r in spark.read.text(str(tmp_path / "index/*/index=cinema")).collect()]
    assert indexed == ["a"] and spark.read.text(str(tmp_path / "index/*/index=books")).count() == 1
    files.console_sink(flow, trigger=ALL_THERE_IS).awaitTermination()


def test_runner_waits_stops_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "n int")
    drop_files(df, tmp_path / "in", [[1]], "n")
    flow = stream_of(spark, df, tmp_path / "in")

    def start(name, rows, trigger):
        return lambda: table_sink(Live(name, rows, trigger=trigger), str(tmp_path / "out"))
    broken = flow.select(F.raise_error(F.lit("no")).alias("x"))
    states = run_queries(spark, {
        "ends": start("ends", flow, ALL_THERE_IS), "breaks": start("breaks", broken, ALL_THERE_IS),
        "waits": start("waits", flow, {"processingTime": "1 second"})}, timeout=20)
    assert states["ends"] == "finished" and states["waits"] == "stopped"
    assert states["breaks"].startswith("failed") and not spark.streams.active


def test_static_left_outer_stream_is_refused(spark, tmp_path):
    sess = sessions(spark)
    drop_files(sess, tmp_path / "s", [[57]], "channel_id")
    shows = schedule.shows_of(channels(spark))
    flow = stream_of(spark, sess, tmp_path / "s")
    outer = shows.join(flow.select("channel_id"), "channel_id", "left_outer")
    with pytest.raises(Exception, match="(?i)not supported|STREAMING"):
        outer.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).start()


def test_keys_of_a_group_are_told_apart(spark, tmp_path):
    """Few calls for many keys: null, large and text keys, over batches, with one state value for a group."""
    big = (1 << 62) + 1
    data = [(key, n, f"2024-01-01 00:0{n}:00", f"type_{n}", n // 2) for key in (None, 0, big, big + 1, *range(3000, 6000)) for n in (0, 1, 2)]
    df = spark.createDataFrame(data, "user_id bigint, event_id bigint, t string, event_type string, batch int") \
        .withColumn("event_ts", F.to_timestamp("t")).drop("t")
    for kind in ("bigint", "string"):
        typed = df.withColumn("user_id", F.col("user_id").cast(kind))
        drop_files(typed, tmp_path / kind, [[0], [1]], "batch")
        live = Live("a", state.activity_parts_stream(stream_of(spark, typed, tmp_path / kind), tiebreak="event_id", clock=state.NEVER))
        query = table_sink(live, str(tmp_path / f"{kind}-out"))
        query.awaitTermination()
        sent = kept(live, str(tmp_path / f"{kind}-out"))
        assert query.lastProgress.stateOperators[0].numRowsTotal <= state.BUCKETS
        assert sorted((r.part, *r.type_ints) for r in sent.where("user_id IS NULL").collect()) == [(0, 0, 1), (1, 2)]
        assert sent.schema["user_id"].dataType == typed.schema["user_id"].dataType
        got = rows(state.activity_days(sent))
        assert got == rows(user_activity(typed, ["event_id"])) and len(got) == 3004


def test_state_partitions_are_bounded(spark, tmp_path):
    """Many shuffle partitions do not become as many state stores; the setting comes back."""
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        acts = actions(spark)
        drop_files(acts, tmp_path / "in", [[1, 2, 3]], "action")
        live = Live("s", state.device_sessions_stream(stream_of(spark, acts, tmp_path / "in"), clock=state.NEVER), "update")
        query = table_sink(live, str(tmp_path / "out"))
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
        assert query.lastProgress.stateOperators[0].numShufflePartitions <= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
