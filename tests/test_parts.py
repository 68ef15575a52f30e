"""Live joins by parts of time, the idle time-out, and draws that a recomputed task cannot change."""

from __future__ import annotations

import glob
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airtally.operators import rowops
from airtally.operators.ranking import ranked
from airtally.operators.sessions import device_sessions
from airtally.plans import live
from airtally.sources.documents import write_index
from airtally.streaming import parts, state
from airtally.streaming.runner import Live, kept, table_sink

DAY = datetime(2024, 1, 1)


def put(spark, folder, data, schema):
    """Each list of rows as a file of its own, in order."""
    for rows in data:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def ran(live, folder):
    query = table_sink(live, str(folder))
    query.awaitTermination()
    return query, kept(live, str(folder))


def hours(n):
    return DAY + timedelta(hours=n)


ACTION = "user_id long, device_id long, channel_id long, action int, action_ts timestamp, event_id long"
# A session of thirty hours, one that is discarded, one that ends on a border, and a clock that goes on.
ACTIONS = [[(1, 1, 5, 1, hours(1), 1), (2, 2, 5, 1, hours(2), 2), (3, 3, 6, 1, hours(3), 3), (3, 3, 6, 2, hours(6), 4)],
           [(9, 9, 9, 0, hours(14), 5)], [(2, 2, 7, 1, hours(15), 6), (9, 9, 9, 0, hours(20), 7)],
           [(1, 1, 5, 2, hours(31), 8), (2, 2, 7, 3, hours(31), 9)]]


@pytest.fixture
def sent(spark, tmp_path):
    flow = put(spark, str(tmp_path / "actions"), ACTIONS, ACTION).withWatermark("action_ts", "1 minute")
    found = state.session_parts_stream(flow, 6 * 3600, "event_id")
    table_sink(Live("p", found), str(tmp_path / "parts")).awaitTermination()
    return spark.read.schema(found.schema.add("batch", "long")).parquet(str(tmp_path / "parts/p/rows"))


def test_parts_come_while_a_session_is_open(spark, sent):
    first = sent.where("user_id = 1").orderBy("part_start").collect()
    assert [(r.part_start, r.part_end) for r in first] == list(zip(
        [hours(h) for h in (1, 6, 12, 18, 24, 30)], [hours(h) for h in (6, 12, 18, 24, 30, 31)]))
    assert [r.closed for r in first] == [False] * 5 + [True]
    assert first[0].batch < first[3].batch <= first[-1].batch
    # A session that ends on a border has a last part of length zero in the cell of its end.
    assert [(r.part_start, r.part_end, r.closed) for r in sent.where("user_id = 3").orderBy("part_start").collect()] == [
        (hours(3), hours(6), False), (hours(6), hours(6), True)]
    actions = spark.createDataFrame([r for rows in ACTIONS for r in rows], ACTION)
    assert sorted(map(tuple, parts.whole_sessions(sent).collect())) == sorted(map(tuple, device_sessions(actions, ["event_id"]).collect()))


def test_ads_and_points_leave_the_state(spark, tmp_path, sent):
    """The early ad of a long session is found, and neither side stays longer than its cell."""
    ads = [[(7, 5, hours(1), hours(2))], [(8, 5, hours(13), hours(13))], [(9, 99, hours(16), hours(17))],
           [(-1, -1, hours(1000), hours(1000))]]
    adverts = parts.in_parts(put(spark, str(tmp_path / "ads"), ads, "ad_id long, channel_id long, start_ts timestamp, end_ts timestamp"),
                             "start_ts", "end_ts", "1 minute")
    batches = [sent.where(F.col("batch") == b).drop("batch") for b in sorted(r[0] for r in sent.select("batch").distinct().collect())]
    end = spark.range(1).select(*[F.lit(-2).cast("long").alias(c) for c in ("user_id", "device_id", "channel_id")],
                                *[F.lit(hours(1000)).alias(c) for c in ("session_start", "part_start", "part_end")], F.lit(False).alias("closed"))
    for rows in [*batches, end]:
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    flow = spark.readStream.schema(end.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    views = parts.ad_view_parts(adverts, parts.in_cell(flow, "part_start", "18 hours"), "left_outer")
    query, rows = ran(Live("v", views), tmp_path / "out")
    # Only the rows that moved the clock are left.
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 2
    known = parts.ended(sent)
    found = parts.whole_views(rows.where("user_id IS NOT NULL"), known, parts.AD, points=False).collect()
    assert sorted((r.ad_id, r.user_id, r.start_ts, r.end_ts) for r in found) == [
        (7, 1, hours(1), hours(2)), (8, 1, hours(13), hours(13))]
    assert [r.ad_id for r in parts.unseen_ads(rows, known).where("ad_id > 0").collect()] == [9]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_points_are_kept_in_groups(spark, tmp_path, kind):
    """Views of a stream get the rows of the plain outer join, and the state holds groups, not rows."""
    view, point = f"program string, device_id {kind}, part_start timestamp, start_ts timestamp, end_ts timestamp", \
        f"device_id {kind}, lon double, lat double, visibility long, kdts timestamp"
    device = (lambda n: n) if kind == "long" else (lambda n: f"d{n}")
    many = [(f"p{k}", device(1), hours(1), hours(1), hours(2)) for k in range(300)]
    views = [[*many, *[("q", device(n), hours(3), hours(3), hours(4)) for n in range(2, 400)], ("w", None, hours(3), hours(3), hours(4))],
             [(None, device(2), hours(8), hours(8), hours(9)), ("r", device(3), hours(8), hours(8), hours(8))],
             [("s", device(3), hours(30), hours(30), hours(31))], [("z", device(-1), hours(999), hours(999), hours(999))]]
    points = [[(device(1), float(k), None, k, hours(1 + k / 299)) for k in range(300)], [(device(2), float("nan"), 0.5, None, hours(3.5))],
              [(device(3), None, -0.0, 4, hours(8)), (device(3), 1.0, 2.0, 4, hours(8)), (None, 1.0, 1.0, 1, hours(8)), (device(3), 1.0, 1.0, 1, None)],
              [(device(-2), 0.0, 0.0, 0, hours(999))]]
    # Rows that come two batches after their cell has passed change nothing.
    late = [("late", device(4), hours(3), hours(3), hours(4))], [(device(5), 1.0, 1.0, 1, hours(3.5))]
    sides = [parts.in_cell(put(spark, str(tmp_path / name), [*data, [], after, []], schema), at, "18 hours")
             for name, data, after, schema, at in (("v", views, late[0], view, "part_start"), ("p", points, late[1], point, "kdts"))]
    query, got = ran(Live("w", parts.with_points(*sides)), tmp_path / "out")
    want = parts.with_points(*[parts.in_cell(spark.createDataFrame([r for rows in data for r in rows], schema), at, "18 hours")
                               for data, schema, at in ((views, view, "part_start"), (points, point, "kdts"))])
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    # What moved the clock waits for the next rows.
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.where("program IS NULL OR program <> 'z'").collect()))
    assert got.where("program LIKE 'p%'").count() == 90_000
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 100


def test_batches_of_a_stream_have_files_of_their_own(spark, monkeypatch):
    """Batches in several files keep their rows together and their order, also where one has too few rows."""
    monkeypatch.setattr(live, "FILE_ROWS", 500)
    rows = spark.range(6000).select("id", F.timestamp_seconds(F.when(F.col("id") < 5990, F.col("id") % 3000).otherwise(F.col("id"))).alias("at"))
    rows = rows.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit(None).cast("timestamp").alias("at")))
    flow = live.in_batches(rows, "flow", "at", {"id": F.lit(-2), "at": F.timestamp_seconds(F.lit(99_999))})
    seen = []

    def keep(batch, number):
        seen.append(sorted(map(tuple, batch.selectExpr("id", "floor(unix_seconds(at) / 1000)").collect())))
    folder = live.new_folder(spark, "seen")
    flow.writeStream.foreachBatch(keep).trigger(availableNow=True).option("checkpointLocation", folder).start().awaitTermination()
    first, last = [(n, n % 3000 // 1000) for n in range(5990)], [(n, 5) for n in range(5990, 6000)]
    assert seen == [sorted([r for r in first if r[1] == k] + ([(-1, None)] if k == 0 else [])) for k in range(3)] + [[], [], last, [(-2, 99)]]


def test_idle_sessions_and_late_rows(spark, tmp_path):
    """A pause closes a session within a batch or between two; a late stop changes nothing."""
    data = [[(1, 1, 5, 1, hours(0), 1), (2, 2, 5, 1, hours(0), 2), (2, 2, 5, 2, hours(5), 3)], [(3, 3, 5, 1, hours(6), 4)],
            [(1, 1, 5, 2, hours(1), 5), (3, 3, 5, 2, hours(6.5), 6)], [(9, 9, 9, 0, hours(90), 7)]]
    flow = put(spark, str(tmp_path / "in"), data, ACTION).withWatermark("action_ts", "1 minute")
    live = Live("i", state.device_sessions_stream(flow, 2 * 3_600_000, "append", "event_id", state.EVENT))
    _, got = ran(live, tmp_path / "out")
    timely = spark.createDataFrame([r for rows in data for r in rows if r[-1] != 5], ACTION)
    want = device_sessions(timely, ["event_id"], expire_open=True, idle="2 HOURS")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert {r.user_id for r in want.where("end_ts = '1970-01-01'").collect()} == {1, 2}


def test_draws_depend_on_the_keys_only(spark):
    df = spark.range(4000).withColumn("label", (F.col("id") % 2).cast("double"))
    train, test = rowops.keyed_split(df, 0.8, ["id"], 3)
    ids = {r.id for r in train.collect()}
    assert ids == {r.id for r in rowops.keyed_split(df.repartition(7), 0.8, ["id"], 3)[0].collect()}
    assert 3050 < len(ids) < 3350 and len(ids) + test.count() == 4000
    some = rowops.keyed_sample(df, "label", {1.0: 0.1, 0.0: 1.0}, ["id"], 3)
    assert some.where("label = 0").count() == 2000 and 140 < some.where("label = 1").count() < 260
    assert rowops.keyed_sample(df, "label", {1.0: 0.0}, ["id"], 3).count() == 0


def test_files_of_an_index_are_bounded(spark, tmp_path):
    rows = spark.range(3000).repartition(40).select(F.concat(F.lit("i"), F.col("id") % 3).alias("index"), F.col("id").cast("string").alias("document"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_index(rows, str(tmp_path / "x"), slices=2)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = glob.glob(str(tmp_path / "x/index=*/part-*"))
    assert len(files) <= 6 and spark.read.text(str(tmp_path / "x")).count() == 3000


def test_a_skewed_ranking_starts_few_jobs(spark):
    df = spark.range(30_000).select((F.col("id") % 3000 == 1).cast("int").alias("rare"), "id",
                                    (F.col("id") * F.col("id") % 1009).alias("amount")).withColumn("key", F.col("rare"))
    spark.sparkContext.setJobGroup("ranked", "few jobs")
    found = ranked(df, ["key"], "amount", ["id"], rows=500)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ranked")) <= 10
    plain = ranked(df, ["key"], "amount", ["id"])
    columns = ["id", "rank", "dense_rank", "row_number", "running_total", "next_val", "prev_val", "first_val", "last_val"]
    assert found.select(columns).exceptAll(plain.select(columns)).isEmpty() and found.count() == 30_000
