"""Round trips through files, topics and the document index.

The inputs are written from the test tables to the shared folder first.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airtally.functions.timecols import string_to_ts
from airtally.plans.live import finish
from airtally.plans.registry import query
from airtally.plans.viewing import ads
from airtally.plans.views import Views
from airtally.session import new_folder
from airtally.sources import documents, feeds, files, topics
from airtally.streaming.runner import ALL_THERE_IS

RATING = feeds.fields(rating_id="long", user_id="long", stars="integer", channel="string",
                      message="string", rated_ts="string")
TOPIC_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


@query("json_file_read", sql="SELECT event_id, user_id, event_type, value FROM events")
def json_file_read(v: Views):
    """JSON lines with an inferred schema."""
    path = new_folder(v.spark, "json")
    v.table("events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return files.json_table(v.spark, path).select("event_id", "user_id", "event_type", "value")


@query("csv_file_read", sql="""
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders""")
def csv_file_read(v: Views):
    """CSV with a header, inferred types and day-first dates."""
    path = new_folder(v.spark, "csv")
    rows = v.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                    F.date_format("o_orderdate", files.CSV_TIME).alias("day"))
    rows.write.csv(path, header=True)
    read = files.csv_table(v.spark, path)
    return read.select(F.col("o_orderkey").cast("bigint"), "o_orderstatus", "o_totalprice",
                       F.col("day").cast("date"))


@query("text_line_read", sql="SELECT c_name AS value FROM customer WHERE contains(c_name, '7')")
def text_line_read(v: Views):
    path = new_folder(v.spark, "lines")
    v.table("customer").select("c_name").write.text(path)
    return files.text_lines(v.spark, path).filter(F.col("value").contains("7"))


@query("parquet_round", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def parquet_round(v: Views):
    rows = v.table("customer").select("c_custkey", "c_name", "c_acctbal")
    return files.parquet_round(rows, new_folder(v.spark, "parquet"))


@query("topic_round", ["ratings"], "SELECT * FROM ratings")
def topic_round(v: Views):
    """Written to a topic and read back; times return as text and are parsed again."""
    bus = new_folder(v.spark, "bus")
    topics.write_topic(v.ratings(), bus, "ratings", key="user_id")
    back = topics.topic_decode(topics.topic_source(v.spark, bus, "ratings", stream=False), RATING)
    return string_to_ts(back, "rated_ts", "rated_ts", TOPIC_TIME).drop("msgoffset", "msgtime")


@query("topic_round_live", same_as="topic_round")
def topic_round_live(v: Views):
    """A topic read as a stream and echoed to a second topic, keyed by a field."""
    bus = new_folder(v.spark, "bus")
    topics.write_topic(v.ratings(), bus, "ratings", key="user_id")
    decoded = topics.topic_decode(topics.topic_source(v.spark, bus, "ratings"), RATING)
    topics.topic_sink(decoded.drop("msgoffset", "msgtime"), bus, "echo", "append",
                      new_folder(v.spark, "checkpoint"), key="rating_id",
                      trigger=ALL_THERE_IS).awaitTermination()
    back = topics.topic_decode(topics.topic_source(v.spark, bus, "echo", stream=False), RATING)
    return string_to_ts(back, "rated_ts", "rated_ts", TOPIC_TIME).drop("msgoffset", "msgtime")


@query("line_topic_live", sql="SELECT c_name AS value FROM customer")
def line_topic_live(v: Views):
    """Line files to a topic, and the topic to line files again, as two streams."""
    source, bus, target = (new_folder(v.spark, name) for name in ("lines", "bus", "lines"))
    v.table("customer").select(F.col("c_name").alias("value")).write.text(source)
    topics.lines_to_topic(files.text_lines(v.spark, source, stream=True), bus, "names", new_folder(v.spark, "checkpoint"),
                          ALL_THERE_IS).awaitTermination()
    lines = topics.message_lines(topics.topic_source(v.spark, bus, "names"))
    files.text_sink(lines, target, new_folder(v.spark, "checkpoint"), trigger=ALL_THERE_IS).awaitTermination()
    return files.text_lines(v.spark, target)


@query("line_files_live", sql="SELECT c_name AS value FROM customer")
def line_files_live(v: Views):
    """Line files as a stream, to line files."""
    path, out = new_folder(v.spark, "lines"), new_folder(v.spark, "lines-out")
    v.table("customer").select("c_name").write.text(path)
    files.text_sink(files.text_lines(v.spark, path, stream=True), out,
                    new_folder(v.spark, "checkpoint"), ALL_THERE_IS).awaitTermination()
    return files.text_lines(v.spark, out)


@query("json_stream_live", sql="SELECT event_id, user_id, event_type FROM events")
def json_stream_live(v: Views):
    """A folder of JSON files as a stream."""
    path = new_folder(v.spark, "json")
    rows = v.table("events").select("event_id", "user_id", "event_type")
    rows.write.json(path)
    return finish(files.json_stream(v.spark, path, rows.schema), "json")


@query("index_sink", same_as="index_export")
def index_sink(v: Views):
    """Documents written to one folder per index, and read back."""
    path = new_folder(v.spark, "index")
    rows = ads(v).withColumn("topic", F.concat(F.lit("testAdOut"), F.col("ad_id") % 2))
    documents.write_index(documents.index_documents(rows, F.col("topic")), path)
    return v.spark.read.text(path).select("index", F.col("value").alias("document"))
