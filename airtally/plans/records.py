"""Topic messages, change rows, record transforms, columns and nested values."""

from __future__ import annotations

from pyspark.sql import functions as F

from airtally.functions import nested, timecols, values
from airtally.operators import changes
from airtally.plans.registry import query
from airtally.plans.viewing import ads
from airtally.plans.views import Views
from airtally.sources import documents, feeds, topics

EVENT = feeds.fields(event_id="long", user_id="long", event_type="string", event_amount="long")
EVENT_KEY = feeds.fields(id="long")
# The fixed point in time the "now" of a query is replaced by.
NOW = "2024-02-01 00:00:00"

DECODED = """CASE WHEN event_id % 97 != 0 THEN event_id END AS event_id,
    CASE WHEN event_id % 97 != 0 THEN user_id END AS user_id,
    CASE WHEN event_id % 97 != 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 97 != 0 THEN event_amount END AS event_amount,
    event_id AS msgoffset, event_ts AS msgtime"""


def _now():
    return F.lit(NOW).cast("timestamp")


@query("topic_json_decode", ["ev"], f"SELECT {DECODED} FROM ev")
def topic_json_decode(v: Views):
    return topics.topic_decode(v.envelope(), EVENT)


@query("topic_json_key_decode", ["ev"], f"SELECT user_id AS id, {DECODED} FROM ev")
def topic_json_key_decode(v: Views):
    return topics.topic_decode(v.envelope(), EVENT, EVENT_KEY)


@query("topic_json_encode", ["ev"], """
SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id
       || ',"event_type":"' || event_type || '","event_amount":' || event_amount || '}' AS value FROM ev""")
def topic_json_encode(v: Views):
    rows = v.events().select("event_id", "user_id", "event_type", "event_amount")
    return topics.topic_encode(rows, "user_id")


@query("topic_from_offset", ["ev"], f"SELECT {DECODED} FROM ev WHERE event_id >= 500")
def topic_from_offset(v: Views):
    return topics.topic_decode(topics.from_offset(v.envelope(), 500), EVENT)


@query("framed_value_split", ["ev", "users"], """
SELECT event_id AS msgoffset, CASE WHEN event_id % 11 != 0 THEN event_id % 25 END AS schema_id,
       CASE WHEN event_id % 11 != 0 THEN event_type END AS payload,
       CASE WHEN event_id % 11 != 0 THEN n_name END AS schema_name
FROM ev LEFT JOIN nation ON n_nationkey = event_id % 25""")
def framed_value_split(v: Views):
    """Values with a schema id in front, joined to a schema table; every 11th is not framed."""
    kind = F.col("event_type").cast("binary")
    framed = topics.frame_value(F.col("event_id") % 25, kind)
    messages = v.events().select(
        F.when(F.col("event_id") % 11 != 0, framed).otherwise(kind).alias("value"),
        F.col("event_id").alias("msgoffset"))
    schemas = v.table("nation").select(F.col("n_nationkey").cast("bigint").alias("schema_id"),
                                       F.col("n_name").alias("schema_name"))
    return topics.split_framed(messages, schemas).select(
        "msgoffset", "schema_id", F.col("payload").cast("string").alias("payload"), "schema_name")


@query("index_export", ["ads"], """
SELECT 'testadout' || (ad_id % 2) AS index, '{"ad_id":' || ad_id || ',"channel_id":' || channel_id
       || ',"start_ts":' || CAST(floor(epoch(start_ts)) AS BIGINT)
       || ',"end_ts":' || CAST(floor(epoch(end_ts)) AS BIGINT)
       || ',"topic":"testAdOut' || (ad_id % 2) || '"}' AS document FROM ads""")
def index_export(v: Views):
    rows = ads(v).withColumn("topic", F.concat(F.lit("testAdOut"), F.col("ad_id") % 2))
    return documents.index_documents(rows, F.col("topic"))


@query("index_route", sql="""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE lower(o_orderpriority) END AS index, count(*) AS count
FROM orders GROUP BY 1""")
def index_route(v: Views):
    topic = F.when(F.col("o_orderstatus") == "F", "Finished").otherwise(F.col("o_orderpriority"))
    named = v.table("orders").select(documents.index_name(topic, {"Finished": "done"}).alias("index"))
    return named.groupBy("index").agg(F.count(F.lit(1)).alias("count"))


@query("change_unwrap", ["chg"], """
SELECT msgoffset AS offset, id, status, price FROM chg WHERE op != 'd'""")
def change_unwrap(v: Views):
    return changes.unwrap_changes(v.changes(), keep=["offset"])


@query("latest_by_key", ["chg"], """
SELECT key, op, msgoffset AS offset, CASE WHEN op != 'd' THEN status END AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY msgtime DESC, msgoffset DESC) AS place FROM chg)
WHERE place = 1""")
def latest_by_key(v: Views):
    newest = changes.latest_by_key(v.changes(), ["key"], ["timestamp", "offset"])
    return newest.select("key", "op", "offset", F.col("after.status").alias("status"))


@query("latest_alive", ["chg"], """
SELECT key, id, status, price FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY msgtime DESC, msgoffset DESC) AS place FROM chg)
WHERE place = 1 AND op != 'd'""")
def latest_alive(v: Views):
    return changes.latest_alive(v.changes(), ["key"], ["timestamp", "offset"])


@query("customer_lookup", ["chg"], """
SELECT strftime(msgtime, '%Y-%m-%d %H:%M:%S') AS row_time, id, status, price FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY msgtime DESC, msgoffset DESC) AS place FROM chg)
WHERE place = 1 AND op != 'd' AND id = 42""")
def customer_lookup(v: Views):
    """The current row of one key; the filter reaches the scan through the grouping."""
    newest = changes.latest_by_key(v.changes(), ["key"], ["timestamp", "offset"])
    row = changes.unwrap_changes(newest.filter(F.col("key") == 42), keep=["timestamp"])
    return row.select(timecols.time_text(F.col("timestamp")).alias("row_time"), "id", "status", "price")


@query("rekeyed_stream", ["chg"], """
SELECT CAST(id AS VARCHAR) AS key, msgoffset AS offset, status FROM chg WHERE op != 'd'""")
def rekeyed_stream(v: Views):
    rows = changes.unwrap_changes(v.changes(), keep=["offset"])
    keyed = changes.key_from_value(rows, "id")
    return keyed.select(F.col("key").cast("string").alias("key"), "offset", "status")


@query("insert_fields", ["chg"], """
SELECT key, msgoffset AS offset, 'orders of the shop' AS messagesource, 'shop.orders' AS messagetopic,
       msgtime AS extract_ts FROM chg""")
def insert_fields(v: Views):
    added = changes.insert_fields(v.changes(), {"messagesource": "orders of the shop"},
                                  "messagetopic", "extract_ts")
    return added.select("key", "offset", "messagesource", "messagetopic", "extract_ts")


@query("insert_time_text", ["chg"], "SELECT key, msgoffset AS offset, '2024/02/01 00:00:00' AS myct FROM chg")
def insert_time_text(v: Views):
    return changes.insert_time_text(v.changes(), now=_now()).select("key", "offset", "myct")


@query("route_by_regex", ["chg"], "SELECT msgoffset AS offset, 'shop.orders-raw' AS topic FROM chg")
def route_by_regex(v: Views):
    return changes.route_by_regex(v.changes(), "(.*)", "$1-raw").select("offset", "topic")


@query("route_by_month", ["chg"], """
SELECT msgoffset AS offset, 'kafka-shop.orders-' || strftime(msgtime, '%Y-%m') AS topic FROM chg""")
def route_by_month(v: Views):
    return changes.route_by_month(v.changes()).select("offset", "topic")


@query("ts_to_text", ["chg"], "SELECT msgoffset AS offset, strftime(msgtime, '%d/%m/%Y %H:%M') AS timestamp FROM chg")
def ts_to_text(v: Views):
    return changes.ts_to_text(v.changes(), "timestamp", "dd/MM/yyyy HH:mm").select("offset", "timestamp")


@query("millis_to_ts", ["li"], "SELECT dc_id, part_id, line, make_timestamp(event_time * 1000) AS evt_ts FROM li")
def millis_to_ts(v: Views):
    return timecols.millis_to_ts(v.nested(), "event_time", "evt_ts").select(
        "dc_id", "part_id", "line", "evt_ts")


@query("string_to_ts", ["li"], """
SELECT dc_id, part_id, line, try_strptime(start_time_str, '%Y-%m-%d %H:%M:%S.%g') AS start_ts,
       CAST(NULL AS TIMESTAMP) AS wrong_ts FROM li""")
def string_to_ts(v: Views):
    """Seconds run past 59 for some rows, and the second format never fits: both give null."""
    right = timecols.string_to_ts(v.nested(), "start_time_str", "start_ts", "yyyy-MM-dd HH:mm:ss.SSS")
    both = timecols.string_to_ts(right, "start_time_str", "wrong_ts", "MM-dd-yyyy HH:mm:ss.SSS")
    return both.select("dc_id", "part_id", "line", "start_ts", "wrong_ts")


@query("expand_timestamp", ["ev"], """
SELECT event_id, CAST(event_ts AS DATE) AS event_date,
       hour(event_ts) || ':' || minute(event_ts) || ':' || second(event_ts) AS event_time,
       CAST(month(event_ts) AS INTEGER) AS event_month, CAST(day(event_ts) AS INTEGER) AS event_day,
       CAST(hour(event_ts) AS INTEGER) AS event_hour, CAST(minute(event_ts) AS INTEGER) AS event_min FROM ev""")
def expand_timestamp(v: Views):
    return timecols.expand_timestamp(v.events().select("event_id", "event_ts"), "event_ts").drop("event_ts")


@query("rebase_time", ["ev"], """
SELECT event_id, TIMESTAMP '2021-02-01 23:55:00' + (event_ts - TIMESTAMP '2024-01-01 00:00:00') AS kdts FROM ev""")
def rebase_time(v: Views):
    moved = timecols.rebase_time(v.events().select("event_id", "event_ts"), "event_ts",
                                 "2024/01/01 00:00:00", "2021/02/01 23:55:00")
    return moved.select("event_id", "kdts")


@query("location_normalise", ["ev"], """
SELECT CASE user_id WHEN 3 THEN 1003 WHEN 5 THEN 1005 ELSE user_id END AS device_id,
       'place-' || (event_id % 4) AS location,
       TIMESTAMP '2021-02-01 23:55:00' + (date_trunc('second', event_ts) - TIMESTAMP '2024-01-01 00:00:00') AS kdts,
       CAST(CAST(event_id % 7 AS FLOAT) / 4 AS DOUBLE) AS lat, CAST(CAST(event_id % 9 AS FLOAT) / 8 AS DOUBLE) AS lon,
       CAST(event_id % 10000 AS INTEGER) AS visibility FROM ev""")
def location_normalise(v: Views):
    """Position messages with a JSON key, decoded, moved in time, devices renumbered."""
    body = F.to_json(F.struct(
        F.date_format("event_ts", timecols.LOCATION_TIME).alias("kdct"),
        F.concat(F.lit("place-"), F.col("event_id") % 4).alias("name"),
        (F.col("event_id") % 10000).alias("visibility"),
        (F.col("event_id") % 9 / 8).alias("lon"), (F.col("event_id") % 7 / 4).alias("lat")))
    key = F.to_json(F.struct(F.col("user_id").alias("id")))
    messages = v.events().select(
        key.cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.col("event_id").alias("offset"), F.col("event_ts").alias("timestamp"))
    decoded = topics.topic_decode(messages, feeds.LOCATION_TOPIC, feeds.LOCATION_KEY)
    moved = feeds.locations_from_topic(decoded, "2024/01/01 00:00:00", "2021/02/01 23:55:00",
                                       {3: 1003, 5: 1005})
    return moved.withColumns({"device_id": F.col("device_id").cast("bigint"),
                              "lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})


@query("value_remap", sql="""
SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 103 WHEN 4 THEN 104 ELSE c_nationkey END AS c_nationkey
FROM customer""")
def value_remap(v: Views):
    return values.remap_values(v.table("customer").select("c_custkey", "c_nationkey"),
                               {3: 103, 4: 104}, ["c_nationkey"])


@query("round_scaled", sql="SELECT vec_id, label, round(CAST(label AS DOUBLE) / 64 * 100, 2) AS scaled FROM embeddings")
def round_scaled(v: Views):
    rows = v.table("embeddings").select("vec_id", "label")
    return rows.withColumn("scaled", values.round_scaled(F.col("label").cast("double") / 64))


@query("type_number", ["numbered"], "SELECT event_id, event_type, type_int FROM numbered")
def type_number(v: Views):
    return v.typed_events().select("event_id", "event_type",
                                   values.type_number(F.col("event_type")).alias("type_int"))


@query("seconds_ago", ["ev"], f"""
SELECT event_id, CAST(epoch(TIMESTAMP '{NOW}') - floor(epoch(event_ts)) AS BIGINT) AS ago FROM ev""")
def seconds_ago(v: Views):
    return timecols.seconds_ago(v.events(), "event_ts", _now()).select("event_id", "ago")


@query("array_sum", ["li"], "SELECT dc_id, part_id, line, qty + line + supp AS sum FROM li")
def array_sum(v: Views):
    return v.nested().select("dc_id", "part_id", "line", nested.array_total(F.col("readings")).alias("sum"))


@query("array_nested_map", ["li"], """
SELECT dc_id, part_id, line, '[[' || (qty + 10) || ',' || (line + 10) || '],[' || (part + 10) || ']]'
       AS new_readings_array FROM li""")
def array_nested_map(v: Views):
    shifted = F.to_json(nested.array_shift(F.col("readings_array"), 10))
    return v.nested().select("dc_id", "part_id", "line", shifted.alias("new_readings_array"))


@query("struct_array_product", ["li"], """
SELECT dc_id, part_id, line, '[' || (qty * line) || ',' || (part * supp) || ']' AS mult_struct FROM li""")
def struct_array_product(v: Views):
    products = F.to_json(nested.pair_products(F.col("struct_array"), "s", "t"))
    return v.nested().select("dc_id", "part_id", "line", products.alias("mult_struct"))


@query("struct_array_exists", ["li"], """
SELECT dc_id, part_id, line, (qty + line > 40 OR part + supp > 40) AS exists_struct FROM li""")
def struct_array_exists(v: Views):
    return v.nested().select("dc_id", "part_id", "line", nested.any_pair_over(
        F.col("struct_array"), "s", "t", 40).alias("exists_struct"))


@query("array_filter", ["li"], """
SELECT dc_id, part_id, line,
       concat_ws(',', CASE WHEN qty > 5 THEN qty END, CASE WHEN line > 5 THEN line END,
                 CASE WHEN supp > 5 THEN supp END) AS filt_temp FROM li""")
def array_filter(v: Views):
    kept = nested.items_over(F.col("readings"), 5).cast("array<string>")
    return v.nested().select("dc_id", "part_id", "line", F.concat_ws(",", kept).alias("filt_temp"))


SENSORS = """SELECT dc_id, part_id, line, 'sensor-igauge' AS kind, part AS id, qty || ',' || line || ',' || supp AS temp FROM li
UNION ALL SELECT dc_id, part_id, line, 'sensor-ipad', supp, line || ',' || part FROM li"""


@query("map_explode", ["li"], f"SELECT dc_id, part_id, line, kind AS key, id FROM ({SENSORS})")
def map_explode(v: Views):
    return v.nested().select("dc_id", "part_id", "line", F.explode("source")).select(
        "dc_id", "part_id", "line", "key", F.col("value.id").alias("id"))


@query("expand_struct", ["li"], """
SELECT dc_id, part_id, line, CAST(l_partkey AS DOUBLE) / 64 AS lat, CAST(l_suppkey AS DOUBLE) / 8 AS long FROM li""")
def expand_struct(v: Views):
    return nested.expand_struct(v.nested().select("dc_id", "part_id", "line", "geo"), "geo")


@query("expand_map", ["li"], f"""
SELECT dc_id, part_id, line, kind AS "deviceType", id, '10.0.0.' || id AS ip, temp FROM ({SENSORS})""")
def expand_map(v: Views):
    rows = nested.expand_map(v.nested().select("dc_id", "part_id", "line", "source"), "source", "deviceType")
    return rows.withColumn("temp", F.concat_ws(",", F.col("temp").cast("array<string>")))


@query("sensor_flatten", sql="""
SELECT 'dc-' || l_orderkey || '-' || l_linenumber AS "dcId", k AS "deviceType", '10.0.0.' || n AS ip,
       n AS "deviceId", 1000 + l_suppkey AS c02_level, l_partkey % 50 AS temp,
       CAST(l_partkey AS DOUBLE) / 64 AS lat, CAST(l_suppkey AS DOUBLE) / 8 AS lon
FROM (SELECT *, 'sensor-igauge' AS k, l_suppkey AS n FROM lineitem
      UNION ALL SELECT *, 'sensor-ipad', l_partkey FROM lineitem)""")
def sensor_flatten(v: Views):
    return nested.sensor_rows(v.iot())
