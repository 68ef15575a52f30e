"""Time columns, nested values, change rows, dashboards, topics: known answers and edges."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from samples import NESTED, at, rows

from airtally.functions import nested, timecols, values
from airtally.operators import changes, dashboards, rowops
from airtally.sources import avro, documents, feeds, files, topics
from airtally.sources.feeds import fields
from pyspark.sql import types as T


@pytest.fixture(scope="module")
def sensors(spark):
    numbers = T.ArrayType(T.IntegerType())
    pair = fields(s="integer", t="integer")
    sensor = fields(id="integer", ip="string", temp=numbers)
    schema = fields(dc_id="string", event_time="long", start_time_str="string", readings=numbers,
                    readings_array=T.ArrayType(numbers), struct_array=T.ArrayType(pair),
                    source=T.MapType(T.StringType(), sensor), geo=fields(lat="double", long="double"))
    return nested.json_rows(spark, json.dumps(NESTED), schema)


def test_time_columns(sensors):
    df = nested.apply_each(
        sensors, lambda d: timecols.millis_to_ts(d, "event_time", "evt_ts"),
        lambda d: timecols.string_to_ts(d, "start_time_str", "start_ts", "MM-dd-yyyy HH:mm:ss.SSS"),
        lambda d: timecols.expand_timestamp(d, "evt_ts"))
    got = df.filter("dc_id = '666'").first()
    assert got.evt_ts == datetime(2017, 2, 21, 22, 22, 55, 521000) and got.start_ts is None
    assert (str(got.evt_date), got.evt_time, got.evt_month, got.evt_day, got.evt_hour, got.evt_min) \
        == ("2017-02-21", "22:22:55", 2, 21, 22, 22)


def test_clock_text_is_not_padded(spark):
    df = spark.sql("SELECT timestamp'2024-03-04 07:05:03' AS show_ts")
    got = timecols.expand_timestamp(df, "show_ts").first()
    assert got.show_time == "7:5:3"
    assert "x_date" in timecols.expand_timestamp(df, "show_ts", "x").columns


def test_arrays(sensors):
    got = {r.dc_id: r for r in sensors.select(
        "dc_id", nested.array_total(F.col("readings")).alias("sum"),
        nested.array_shift(F.col("readings_array"), 10).alias("shifted"),
        nested.pair_products(F.col("struct_array"), "s", "t").alias("product"),
        nested.any_pair_over(F.col("struct_array"), "s", "t", 10).alias("over")).collect()}
    assert (got["666"].sum, got["777"].sum) == (14, 17)
    assert got["666"].shifted == [[12, 15], [19, 13]]
    assert got["666"].product == [228, 476] and got["777"].product == [1998, 3486]
    assert got["666"].over and got["777"].over


def test_struct_and_map(sensors):
    flat = nested.expand_struct(sensors.select("dc_id", "geo"), "geo")
    scaled = flat.select("dc_id", values.round_scaled(F.col("lat")), values.round_scaled(F.col("long")))
    assert rows(scaled) == [("666", 2839.39, 1639.1), ("777", 4238.33, 7916.38)]
    per_sensor = nested.expand_map(sensors.select("dc_id", "source"), "source", "deviceType")
    kept = per_sensor.select("dc_id", "deviceType", "id", "ip",
                             nested.items_over(F.col("temp"), 5).alias("kept"))
    assert rows(kept) == [
        ("666", "sensor-igauge", 10, "68.28.91.22", [35, 41]),
        ("666", "sensor-ipad", 13, "67.185.72.1", [6, 19, 51]),
        ("777", "sensor-igauge", 18, "68.29.12.7", [84, 27, 55]),
        ("777", "sensor-ipad", 22, "67.142.71.5", [67, 66, 9])]


def test_rebase_and_remap(spark):
    decoded = spark.createDataFrame(
        [(2963597, "2021/05/18 10:30:12", "Ireland", 10000, -8.0, 53.0),
         (4254884, "2021/05/18 10:31:14", "Brazil", 14, -87.125, 39.5237)],
        "id int, kdct string, name string, visibility int, lon float, lat float")
    got = rows(feeds.locations_from_topic(decoded), "device_id", "kdts", "visibility")
    assert got == [(14, at("2021-02-01 23:55:00"), 10000), (16, at("2021-02-01 23:56:02"), 14)]


def test_type_number_edges(spark):
    df = spark.createDataFrame([("type_7",), ("type_",), ("type_x",), ("other",), (None,)], "t string")
    assert [r[0] for r in df.select(values.type_number(F.col("t"))).collect()] == [7, None, None, None, None]


def test_seconds_ago_equals_a_pandas_udf(spark):
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 977).alias("t"))
    now = datetime(2024, 1, 1)

    @pandas_udf("long")
    def slow(t):
        import pandas as pd
        return (pd.Timestamp(now) - t).dt.total_seconds().astype("int64")
    native = timecols.seconds_ago(df, "t", F.lit("2024-01-01").cast("timestamp"))
    assert native.filter(F.col("ago") != slow("t")).count() == 0


def test_changes(spark):
    data = [(1, "c", (1, "a"), 0), (1, "u", (1, "b"), 1), (2, "c", (2, "c"), 2), (2, "d", None, 3),
            (3, "u", (3, None), 4)]
    df = spark.createDataFrame(data, "key int, op string, after struct<id: int, s: string>, offset long")
    assert rows(changes.unwrap_changes(df)) == [(1, "a"), (1, "b"), (2, "c"), (3, None)]
    assert rows(changes.latest_by_key(df, ["key"], ["offset"]), "key", "op") == [(1, "u"), (2, "d"), (3, "u")]
    assert rows(changes.latest_alive(df, ["key"], ["offset"])) == [(1, 1, "b"), (3, 3, None)]


def test_routing(spark):
    df = spark.sql("SELECT 'demo.a' AS topic, timestamp'2024-12-30 00:00:00' AS timestamp")
    assert changes.route_by_regex(df, "(.*)", "$1-raw").first().topic == "demo.a-raw"
    assert changes.route_by_regex(df, "demo", "x").first().topic == "demo.a"
    assert changes.route_by_month(df).first().topic == "kafka-demo.a-2024-12"
    text = changes.insert_time_text(df, "ct", F.lit("2024-01-02 03:04:05").cast("timestamp")).first().ct
    assert text == "2024/01/02 03:04:05"
    named = changes.insert_fields(df, {"src": "x"}, "t", "at").first()
    assert (named.src, named.t, named.at) == ("x", "demo.a", datetime(2024, 12, 30))
    assert changes.ts_to_text(df, "timestamp", "yyyy").first().timestamp == "2024"


def test_index_documents(spark):
    df = spark.sql("SELECT 1 AS id, timestamp'1970-01-01 00:01:00' AS start_ts, 'testAdOut9' AS topic "
                   "UNION ALL SELECT 2, timestamp'1970-01-01 00:01:00', 'Other'")
    got = {r["index"]: json.loads(r.document) for r in documents.index_documents(df, F.col("topic")).collect()}
    assert got["testadout9"]["start_ts"] == 60
    assert got["other"]["start_ts"].startswith("1970-01-01T00:01:00")


def test_report_uses_the_usual_names(spark):
    df = spark.createDataFrame([(1, 1)] * 6 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)], "label int, prediction int")
    got = dashboards.classification_report(df).first()
    assert (got.true_pos, got.false_pos, got.false_neg, got.true_neg) == (0.6, 0.2, 0.1, 0.1)
    assert got.precision == pytest.approx(6 / 8) and got.recall == pytest.approx(6 / 7)
    assert got.accuracy == pytest.approx(0.7)


def test_topic_decode_edges(spark):
    messages = spark.createDataFrame(
        [(b'{"id": 1}', b'{"a": 5, "extra": 1}', 3), (b"", b"broken", 4), (None, None, 5)],
        "key binary, value binary, offset long").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = topics.topic_decode(messages, fields(a="integer", b="string"), fields(id="integer"))
    assert got.columns == ["id", "a", "b", "msgoffset", "msgtime"]
    assert rows(got, "id", "a", "b", "msgoffset") == [(1, 5, None, 3), (None, None, None, 4), (None, None, None, 5)]
    assert topics.from_offset(messages, 9).count() == 0


def test_topic_round_trip(spark, tmp_path):
    people = spark.createDataFrame([(1, "a", "2021-02-01T23:56:27.000Z"), (2, None, "x")],
                                   "id int, name string, start string")
    topics.write_topic(people, str(tmp_path), "people", key="id")
    topics.write_topic(people, str(tmp_path), "people", key="id")  # a repeated batch replaces itself
    topics.write_topic(people.filter("id = 1"), str(tmp_path), "people", key="id", batch=1)
    back = topics.topic_decode(topics.topic_source(spark, str(tmp_path), "people", stream=False),
                               people.schema)
    assert back.count() == 3
    # Timestamps come back as text and are repaired by format.
    repaired = timecols.string_to_ts(back.filter("msgoffset IS NULL"), "start", "ts", timecols.ISO_MILLIS)
    assert {r.id: r.ts for r in repaired.collect()} == {1: at("2021-02-01 23:56:27"), 2: None}


def test_framing(spark):
    df = spark.createDataFrame([(300, b"abc"), (0, b"")], "n long, body binary").select(
        topics.frame_value(F.col("n"), F.col("body")).alias("value"))
    other = spark.createDataFrame([(b"\x01abcdef",), (b"\x00\x01",)], "value binary")
    got = topics.split_framed(df.union(other)).collect()
    assert [(r.schema_id, r.payload) for r in got] \
        == [(300, b"abc"), (0, b""), (None, None), (None, None)]
    names = spark.createDataFrame([(300, "event-value")], "schema_id long, subject string")
    assert {r.subject for r in topics.split_framed(df, names).collect()} == {"event-value", None}


def test_avro_schema_and_round_trip(spark):
    schema = fields(id="integer", name="string", tags=T.ArrayType(T.StringType()), at="timestamp")
    text = json.loads(avro.avro_schema(schema))
    assert [f["type"][0] for f in text["fields"]] == ["null"] * 4
    assert avro.subject_of("people") == "people-value"
    if not avro.avro_available(spark):
        pytest.skip("Spark's Avro package is not on the class path")
    df = spark.createDataFrame([(1, "a", ["x"], at("2024-01-01 00:00:00"))], schema)
    for schema_id in (None, 7):
        back = avro.avro_decode(avro.avro_encode(df, schema_id), avro.avro_schema(schema), schema_id is not None)
        assert rows(back) == rows(df)


def test_files(spark, tmp_path):
    (tmp_path / "people.json").write_text('{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}\n')
    people = files.json_table(spark, str(tmp_path / "people.json"))
    teens = rowops.sql_on(people, "SELECT name FROM {df} WHERE age BETWEEN 13 AND 19")
    assert rows(teens) == [("Justin",)]
    (tmp_path / "trades.csv").write_text("id,day\n1,03/02/2021\n2,04/02/2021\n")
    trades = files.csv_table(spark, str(tmp_path / "trades.csv"))
    top = rowops.sort_top(trades, "day", 1, ["id"]).first()
    assert (top.id, str(top.day)[:10]) == (2, "2021-02-04")
    lines = files.text_lines(spark, str(tmp_path / "people.json"))
    assert tuple(dashboards.contains_counts(lines, "value", ["age", "Justin"]).first()) == (3, 2, 1)
    again = files.parquet_round(people, str(tmp_path / "p"))
    assert again.schema == people.schema and rows(again) == rows(people)
    seen = spark.sparkContext.accumulator(0)
    rowops.for_each_batch_of_rows(people, lambda part: seen.add(sum(1 for _ in part)))
    assert seen.value == 3
