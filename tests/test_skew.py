"""Split, salted and cell-based plans give what the plain plans give."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from compare import spark_result, sql_result
from pyspark.sql import Window
from pyspark.sql import functions as F
from samples import SALARIES, ads, channels, locations, rows, sessions, users

from airtally.operators import enrich, schedule
from airtally.operators.intervals import (OVERLAP, POINTS, Grid, _entries, _spans, interval_overlap,
                                          point_in_interval)
from airtally.operators.ranking import ranked
from airtally.operators.sessions import device_sessions, type_spans, user_activity
from airtally.operators.skew import cut_groups, hot_keys, lead_rows, salted_join

DAY = datetime(2024, 1, 1)


def spread_intervals(seed, n, days=3):
    """Touching, empty, inverted, endless and null intervals on few keys."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = DAY + timedelta(seconds=rng.randrange(0, days * 86400, 60))
        length = rng.choice([0, 60, 300, 3600, 40_000, 86_400, 700_000, 40_000_000])
        end = start + timedelta(seconds=rng.randrange(0, length + 1, 60))
        if rng.random() < 0.1:
            end = datetime(1970, 1, 1)
        key = 1 if rng.random() < 0.4 else rng.randrange(5)
        out.append((i, rng.choice([key] * 20 + [None]), start, None if rng.random() < 0.03 else end))
    return out


@pytest.fixture(scope="module")
def intervals(spark):
    schema = "id int, key int, start_ts timestamp, end_ts timestamp"
    return (spark.createDataFrame(spread_intervals(1, 150), schema),
            spark.createDataFrame(spread_intervals(2, 130), schema))


@pytest.mark.parametrize("how", ["inner", "left_outer"])
@pytest.mark.parametrize("grid,hot_rows", [(OVERLAP, None), (OVERLAP, 5), (Grid(600, 64, 2, 63), None)])
def test_overlap_by_cells_equals_plain(intervals, how, grid, hot_rows):
    a, b = intervals
    want = rows(interval_overlap(a, b, "key", how, method="plain"))
    assert len(want) > 500
    assert rows(interval_overlap(a, b, "key", how, grid=grid, hot_rows=hot_rows)) == want


@pytest.mark.parametrize("how", ["inner", "left_outer"])
@pytest.mark.parametrize("grid,hot_rows", [(POINTS, None), (POINTS, 4), (OVERLAP, None)])
def test_points_by_cells_equal_plain(spark, intervals, how, grid, hot_rows):
    views = intervals[0]
    rng = random.Random(3)
    points = spark.createDataFrame(
        [(rng.choice([0, 1, 1, 2, 3, None]), DAY + timedelta(seconds=rng.randrange(0, 5 * 86400, 60)), i)
         for i in range(200)], "key int, kdts timestamp, n int")
    want = rows(point_in_interval(views, points, "key", how=how, method="plain"))
    assert len(want) > 300
    got = point_in_interval(views, points, "key", how=how, grid=grid, hot_rows=hot_rows)
    assert got.columns == point_in_interval(views, points, "key", how=how, method="plain").columns
    assert rows(got) == want


def test_long_intervals_do_not_share_one_cell(spark):
    """Intervals of years are spread over the widest cells, on either side, once a pair."""
    start = F.timestamp_seconds(F.lit(946_684_800) + F.col("id") * 86_400 * 9)
    long = spark.range(800).select("id", F.lit(1).alias("key"), start.alias("start_ts"),
                                   (start + F.expr("INTERVAL 5 YEARS")).alias("end_ts"))
    entries = _entries(_spans(long, "key", "start_ts", "end_ts", OVERLAP), [], OVERLAP)
    cells = [r["count"] for r in entries.groupBy("key", "level", "cell").count().collect()]
    assert sum(cells) <= 3 * 800 and max(cells) < 400
    short = spark.range(300).select("id", F.lit(1).alias("key"), start.alias("start_ts"),
                                    (start + F.expr("INTERVAL 1 HOUR")).alias("end_ts"))
    for a, b in ((long, short), (short, long), (long, long)):
        assert rows(interval_overlap(a, b, "key", hot_rows=100), "a_id", "b_id") \
            == rows(interval_overlap(a, b, "key", method="plain"), "a_id", "b_id")


def test_pairs_of_a_crowded_cell_come_in_runs(spark):
    """A merge join holds the spread rows, so a right row's pairs stand together and files stay small."""
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 5)

    def spans(n):
        return spark.range(n).select("id", F.lit(1).alias("key"), start.alias("start_ts"),
                                     (start + F.expr("INTERVAL 1 HOUR")).alias("end_ts"))

    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        got = [(r.a_id, r.b_id) for r in interval_overlap(spans(300), spans(60), "key", hot_rows=100).collect()]
    finally:
        spark.conf.set(broadcast, kept)
    assert sorted(got) == [(a, b) for a in range(300) for b in range(60)]
    assert sum(one[1] != two[1] for one, two in zip(got, got[1:])) < len(got) / 10


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_full_pipelines_with_crowded_cells(spark, hot_rows):
    shows, watched = schedule.shows_of(channels(spark)), sessions(spark)
    got = rows(enrich.show_watch_full(watched, shows, users(spark), locations(spark), hot_rows=hot_rows))
    views = enrich.with_demographics(enrich.show_views(watched, shows, "plain"), users(spark))
    assert got == rows(enrich.with_locations(views, locations(spark), method="plain"))
    got = rows(enrich.ad_view_full(ads(spark), watched, users(spark), locations(spark), hot_rows=hot_rows))
    views = enrich.with_demographics(enrich.ad_views(ads(spark), watched, method="plain"), users(spark))
    assert got == rows(enrich.with_locations(views, locations(spark), method="plain"))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some at the same instant, some without a time."""
    rng = random.Random(5)
    data = []
    for i in range(400):
        key = 7 if rng.random() < 0.35 else rng.randrange(40)
        ts = None if rng.random() < 0.02 else DAY + timedelta(minutes=rng.randrange(300))
        data.append((i, key, ts, rng.randrange(6), rng.randrange(30)))
    return spark.createDataFrame(data, "id int, key int, ts timestamp, code int, amount long")


def test_cut_groups_splits_only_hot_keys(skewed):
    found = cut_groups(skewed, ["key"], ["ts", "id"], rows=20)
    cut = found.rows
    sizes = {r.key: r.n for r in cut.groupBy("key").agg(F.countDistinct("piece").alias("n")).collect()}
    assert sizes[7] > 4 and all(n == 1 for k, n in sizes.items() if k != 7)
    assert cut.count() == 400 and found.pieces >= sizes[7]
    assert cut_groups(skewed, ["key"], ["ts"], rows=1000) is None


def test_bursts_and_copies_are_cut_too(spark):
    """A key with a burst in one second, many copies of one instant, and no times."""
    data = [(i, 1, DAY + timedelta(seconds=5)) for i in range(200)]
    data += [(i, 1, DAY + timedelta(days=30, microseconds=i)) for i in range(200, 400)]
    data += [(i, 1, None) for i in range(400, 500)] + [(i, 2, DAY) for i in range(500, 520)]
    df = spark.createDataFrame(data, "id int, key int, ts timestamp")
    cut = cut_groups(df, ["key"], ["ts", "id"], rows=20).rows
    assert cut.groupBy("key", "piece").count().agg(F.max("count")).first()[0] <= 60
    w = Window.partitionBy("key").orderBy("ts", "id")
    want = rows(df.select("id", F.lead("id").over(w), F.lead("ts").over(w)))
    assert rows(lead_rows(df, ["key"], ["ts", "id"], ["id", "ts"], rows=20), "id", "next_id", "next_ts") == want
    amounts = df.withColumn("amount", F.unix_micros("ts"))
    down = Window.partitionBy("key").orderBy(F.desc("amount"), "id")
    want = rows(amounts.select("id", F.row_number().over(down), F.rank().over(
        Window.partitionBy("key").orderBy(F.desc("amount")))))
    assert rows(ranked(amounts, ["key"], "amount", ["id"], rows=20), "id", "row_number", "rank") == want


def test_lead_rows_equals_window(skewed):
    w = Window.partitionBy("key").orderBy("ts", "id")
    want = rows(skewed.select("id", F.lead("code").over(w), F.lead("ts").over(w)))
    for limit in (5, 20, 1000):
        got = lead_rows(skewed, ["key"], ["ts", "id"], ["code", "ts"], rows=limit)
        assert rows(got, "id", "next_code", "next_ts") == want


def test_sessions_of_a_hot_device_equal_a_walk(spark, skewed):
    acts = skewed.filter("ts IS NOT NULL").selectExpr(
        "id", "key AS user_id", "key AS device_id", "amount AS channel_id", "code AS action", "ts AS action_ts")
    want, opened = [], {}
    for r in sorted(acts.collect(), key=lambda r: (r.action_ts, r.id)):
        if r.action in (2, 3) and r.user_id in opened:
            channel, start = opened.pop(r.user_id)
            want.append((r.user_id, r.device_id, channel, start, r.action_ts))
        if r.action in (1, 3):
            opened[r.user_id] = (r.channel_id, r.action_ts)
    for limit in (5, 1000):
        assert rows(device_sessions(acts, ["id"], rows=limit)) == sorted(want, key=repr)
    open_too = device_sessions(acts, ["id"], expire_open=True, rows=5)
    assert open_too.filter("unix_micros(end_ts) = 0").count() == len(opened)
    assert open_too.count() == len(want) + len(opened)


def test_ranked_equals_windows(skewed):
    w = Window.partitionBy("key").orderBy(F.desc("amount"))
    exact = Window.partitionBy("key").orderBy(F.desc("amount"), "id")
    tail = exact.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    want = rows(skewed.select(
        "id", F.rank().over(w), F.dense_rank().over(w), F.row_number().over(exact),
        F.sum("amount").over(w), F.lead("amount", 1, 0).over(exact), F.lag("amount", 1, 0).over(exact),
        F.first("amount").over(exact), F.last("amount").over(tail)))
    names = ["id", "rank", "dense_rank", "row_number", "running_total", "next_val", "prev_val",
             "first_val", "last_val"]
    for limit in (10, 40, 1000):
        assert rows(ranked(skewed, ["key"], "amount", ["id"], rows=limit), *names) == want


def test_ranked_ascending(skewed):
    exact = Window.partitionBy("key").orderBy("amount", "id")
    want = rows(skewed.select("id", F.row_number().over(exact), F.lead("amount", 1, 0).over(exact)))
    got = ranked(skewed, ["key"], "amount", ["id"], descending=False, rows=10)
    assert rows(got, "id", "row_number", "next_val") == want


def test_ranking_of_salaries(spark):
    df = spark.createDataFrame(SALARIES, "empno int, sal long, deptno int")
    got = {r.empno: r for r in ranked(df, ["deptno"], "sal", ["empno"]).collect()}
    assert [(got[e].rank, got[e].dense_rank, got[e].row_number) for e in (7521, 7654)] == [(4, 4, 4), (4, 4, 5)]
    assert got[7521].running_total == got[7654].running_total == 2850 + 1600 + 1500 + 1250 * 2
    assert (got[7698].next_val, got[7698].prev_val, got[7698].first_val, got[7698].last_val) \
        == (1600, 0, 2850, 1250)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_join(spark, skewed, how):
    names = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 3)] + [(7, "a"), (7, "b")],
                                  "key int, name string")
    want = rows(skewed.join(names, "key", how), "id", "name")
    assert rows(salted_join(skewed, names, ["key"], how, rows=10), "id", "name") == want
    hot = hot_keys(skewed, ["key"], rows=10)
    assert rows(salted_join(skewed, names, ["key"], how, hot=hot), "id", "name") == want


def test_activity_of_a_hot_user_is_whole(skewed):
    events = skewed.selectExpr("id", "key AS user_id", "ts AS event_ts",
                               "concat('type_', if(id % 13 = 0, '', string(amount % 10))) AS event_type")
    want = {}
    for r in sorted(events.filter("event_ts IS NOT NULL").collect(),
                    key=lambda r: (r.event_ts, r.id)):
        if r.event_type != "type_":
            types, start, end = want.get(r.user_id, ([], datetime(1970, 1, 1), datetime(1970, 1, 1)))
            n = int(r.event_type[5:])
            want[r.user_id] = (types + [n], r.event_ts if n < 4 else start, r.event_ts if n >= 7 else end)
    got, days = {}, user_activity(events, ["id"]).collect()
    for r in sorted(days, key=lambda r: (r.user_id, r.day)):
        types, start, end = got.get(r.user_id, ([], datetime(1970, 1, 1), datetime(1970, 1, 1)))
        got[r.user_id] = (types + list(r.type_ints), max(start, r.start), max(end, r.end))
    assert got == want
    # The shape is that of the days, however heavy a user is.
    assert len(days) == events.filter("event_ts IS NOT NULL AND event_type <> 'type_'").selectExpr(
        "user_id", "to_date(event_ts)").distinct().count()
    spans = {(r.user_id, r.type_int): (r.start, r.end) for r in type_spans(events).collect()}
    single = [v for v in spans.values() if v[1] == datetime(1970, 1, 1)]
    assert len(spans) > 100 and single


def test_activity_query_gives_one_row_per_user(spark, tmp_path):
    """The query's list is the user's whole one over all days, a time before 1970 included."""
    from __spark_entry__ import ORACLES, QUERIES
    data = [(e, f"{day} 10:00:00", user, "view", 1.0) for e, (day, user) in enumerate(
        [("2024-01-03", 1), ("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-01", 2), ("1969-12-30", 3), ("1969-12-31", 3), ("2024-01-02", 1)], 1)]
    events = spark.createDataFrame(data, "event_id long, t string, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert spark_result(QUERIES["user_activity"](spark, str(tmp_path))) == sql_result(con, ORACLES["user_activity"])
    got = {r.user_id: (r.part, r.type_ints) for r in QUERIES["user_activity"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, "4,1,9,7"), 2: (0, "8"), 3: (0, "5,2")}
