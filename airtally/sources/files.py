"""File sources and sinks, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

# Trigger of the file sink, date format of the CSV feed.
SINK_TRIGGER = {"processingTime": "10 seconds"}
CSV_TIME = "dd/MM/yyyy"


def json_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_trigger: int | None = 1) -> DataFrame:
    """A folder or glob of JSON files as a stream; ``None`` takes all files at once."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def json_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; the schema is inferred when none is given."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def csv_table(spark: SparkSession, path: str, time_format: str = CSV_TIME) -> DataFrame:
    """CSV with a header row, inferred types and day-first dates."""
    return spark.read.options(header=True, inferSchema=True, timestampFormat=time_format,
                              dateFormat=time_format).csv(path)


def text_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Lines of text files in column ``value``."""
    return (spark.readStream if stream else spark.read).text(path)


def parquet_round(df: DataFrame, path: str) -> DataFrame:
    """Write a table, replacing what is there, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def json_sink(df: DataFrame, path: str, checkpoint: str, files: int | None = None,
              trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a folder of JSON files. ``files`` sets the number of files
    per trigger, for small streams only; by default each task writes its own."""
    rows = df.coalesce(files) if files else df
    return (rows.writeStream.format("json").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or SINK_TRIGGER)).start())


def text_sink(df: DataFrame, path: str, checkpoint: str,
              trigger: dict | None = None) -> StreamingQuery:
    """Append a stream with one text column to a folder of line files."""
    return (df.writeStream.format("text").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or SINK_TRIGGER)).start())


def parquet_sink(df: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or SINK_TRIGGER)).start())


def console_sink(df: DataFrame, mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    """Print a stream, to look at while developing."""
    writer = df.writeStream.format("console").outputMode(mode)
    return (writer.trigger(**trigger) if trigger else writer).start()


def memory_sink(df: DataFrame, name: str, mode: str = "append",
                trigger: dict | None = None) -> StreamingQuery:
    """Keep a small stream as an in-memory table that SQL can poll. The rows live
    on the driver, so this is for looking at, not for results."""
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    return (writer.trigger(**trigger) if trigger else writer).start()
