"""Topics: decoding and encoding messages, reading and writing them.

A topic is a DataFrame of messages ``key, value, topic, partition, offset,
timestamp``, batch or streaming. It comes from a broker when Spark's Kafka package
is on the class path, or from a folder of Parquet messages. Only a broker numbers messages:
what is written to a folder has no partition and no offset, recorded messages keep theirs.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the columns of a message.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType())])

BROKERS = "kafka:"  # prefix of a location that names brokers
# Framing of registry values, one magic byte and a 4-byte schema id.
MAGIC, FRAME = b"\x00", 5


def topic_decode(messages: DataFrame, schema: T.StructType,
                 key_schema: T.StructType | None = None) -> DataFrame:
    """JSON values (and keys, with ``key_schema``) to plain columns, key fields first,
    then ``msgoffset`` and ``msgtime``. Text that is not JSON gives nulls."""
    parts = [F.from_json(F.col("value").cast("string"), schema).alias("data")]
    flat = ["data.*"]
    if key_schema is not None:
        parts.insert(0, F.from_json(F.col("key").cast("string"), key_schema).alias("id"))
        flat.insert(0, "id.*")
    return messages.select(*parts, F.col("offset").alias("msgoffset"),
                           F.col("timestamp").alias("msgtime")) \
        .select(*flat, "msgoffset", "msgtime")


def topic_encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """All columns as one JSON ``value``; ``key`` is a column as text, or absent."""
    value = F.to_json(F.struct("*")).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def from_offset(messages: DataFrame, offset: int) -> DataFrame:
    """Messages at or after ``offset``, in every partition of the topic."""
    return messages.filter(F.col("offset") >= offset) if offset else messages


def split_framed(messages: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """Add ``schema_id`` and ``payload`` of framed values, null for others; with
    ``schemas(schema_id, ...)`` its columns too. The schema table may be any size,
    so Spark picks the join."""
    framed = (F.substring("value", 1, 1) == F.lit(MAGIC)) & (F.length("value") >= FRAME)
    schema_id = F.conv(F.hex(F.substring("value", 2, 4)), 16, 10).cast("bigint")
    payload = F.expr(f"substring(value, {FRAME + 1})")
    split = messages.withColumns({"schema_id": F.when(framed, schema_id),
                                  "payload": F.when(framed, payload)})
    return split if schemas is None else split.join(schemas, "schema_id", "left")


def frame_value(schema_id: Column, payload: Column) -> Column:
    """A payload with the magic byte and its schema id in front."""
    return F.concat(F.lit(MAGIC), F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")), payload)


def _broker_options(location: str, topic: str, offset: int, partitions: int | None) -> dict:
    """Reader options. Each partition starts at the offset, so nothing before it is read."""
    starting = "earliest"
    if offset:
        if not partitions:
            raise ValueError("reading a broker from an offset needs the topic's number of partitions")
        starting = json.dumps({topic: {str(p): offset for p in range(partitions)}})
    return {"kafka.bootstrap.servers": location.removeprefix(BROKERS), "subscribe": topic, "startingOffsets": starting}


def topic_source(spark: SparkSession, location: str, topic: str, offset: int = 0,
                 stream: bool = True, partitions: int | None = None) -> DataFrame:
    """Messages of a topic from ``kafka:<brokers>`` or from a folder of messages."""
    reader = spark.readStream if stream else spark.read
    if location.startswith(BROKERS):
        options = _broker_options(location, topic, offset, partitions)
        read = reader.format("kafka").options(**options).load()
        return read.select(*MESSAGE.fieldNames())
    folder = os.path.join(location, topic)
    return from_offset(reader.schema(MESSAGE).option("recursiveFileLookup", "true")
                       .parquet(folder), offset)


def as_envelopes(encoded: DataFrame, topic: str) -> DataFrame:
    """Encoded rows as messages before a broker has numbered them: key, value, topic, time."""
    key = F.col("key") if "key" in encoded.columns else F.lit(None).cast("string")
    return encoded.select(key.cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                          F.lit(topic).alias("topic"), F.current_timestamp().alias("timestamp"))


def _write_batch(encoded: DataFrame, location: str, topic: str, batch: int) -> None:
    if location.startswith(BROKERS):
        (encoded.write.format("kafka").option("topic", topic)
         .option("kafka.bootstrap.servers", location.removeprefix(BROKERS)).save())
    else:
        as_envelopes(encoded, topic).write.mode("overwrite").parquet(os.path.join(location, topic, f"batch{batch}"))


def write_topic(df: DataFrame, location: str, topic: str, key: str | None = None,
                batch: int = 0) -> None:
    """Write a bounded DataFrame as one batch of messages. Writing the same batch to a
    folder again replaces it, so a repeated batch leaves no second copy."""
    _write_batch(topic_encode(df, key), location, topic, batch)


def _sink(encoded: DataFrame, location: str, topic: str, mode: str, checkpoint: str,
          trigger: dict | None) -> StreamingQuery:
    if location.startswith(BROKERS):
        writer = (encoded.writeStream.format("kafka").option("topic", topic)
                  .option("kafka.bootstrap.servers", location.removeprefix(BROKERS)))
    else:
        writer = encoded.writeStream.foreachBatch(lambda rows, batch: _write_batch(rows, location, topic, batch))
    writer = writer.outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def topic_sink(df: DataFrame, location: str, topic: str, mode: str, checkpoint: str,
               key: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Stream a DataFrame to a topic as JSON."""
    return _sink(topic_encode(df, key), location, topic, mode, checkpoint, trigger)


def lines_to_topic(lines: DataFrame, location: str, topic: str, checkpoint: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Stream lines of text (column ``value``) to a topic, each as the value of a message as it is."""
    return _sink(lines.select("value"), location, topic, "append", checkpoint, trigger)


def message_lines(messages: DataFrame) -> DataFrame:
    """The values of messages as lines of text; messages without a value give none."""
    return messages.filter(F.col("value").isNotNull()).select(F.col("value").cast("string").alias("value"))
