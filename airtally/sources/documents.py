"""Export to a document index: one JSON document per row, grouped by index name."""

from __future__ import annotations

from fnmatch import translate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Which indexes carry epoch-second dates, and in which fields.
EPOCH_INDEXES = "testAdOut*"
EPOCH_FIELDS = ["start_ts", "end_ts"]
#: Files of one index in one write.
SLICES = 16


def index_name(topic: Column, names: dict[str, str] | None = None) -> Column:
    """Index of a topic: by the given map, otherwise the name in lower case."""
    chosen = None
    for source, target in (names or {}).items():
        hit = topic == source
        chosen = F.when(hit, target) if chosen is None else chosen.when(hit, target)
    return F.lower(topic) if chosen is None else chosen.otherwise(F.lower(topic))


def index_documents(df: DataFrame, topic: Column, names: dict[str, str] | None = None,
                    pattern: str = EPOCH_INDEXES, date_fields: list[str] | None = None) -> DataFrame:
    """``index, document`` per row. For indexes that fit ``pattern`` (in any case, as
    index names are lower) the date fields become epoch seconds; keys are ignored."""
    dates = EPOCH_FIELDS if date_fields is None else date_fields
    named = df.withColumn("index", index_name(topic, names))
    fields = [c for c in df.columns]
    epoch = F.to_json(F.struct(*[
        F.unix_seconds(F.col(c).cast("timestamp")).alias(c) if c in dates else F.col(c)
        for c in fields]))
    plain = F.to_json(F.struct(*fields))
    fits = F.col("index").rlike("(?i)^" + translate(pattern).removesuffix(r"\Z").removesuffix(r"\z") + "$")
    return named.select("index", F.when(fits, epoch).otherwise(plain).alias("document"))


def write_index(documents: DataFrame, path: str, slices: int = SLICES) -> None:
    """Documents as lines of JSON in one folder per index.

    Rows are gathered by index and slice first, so an index has at most ``slices`` files, however many
    tasks made its documents, and a large index is not one task's work.
    """
    gathered = documents.repartition("index", F.pmod(F.xxhash64("document"), F.lit(slices)))
    gathered.write.mode("overwrite").partitionBy("index").text(path)


def index_sink(df: DataFrame, topic: Column, path: str, checkpoint: str,
               names: dict[str, str] | None = None, mode: str = "append",
               trigger: dict | None = None) -> StreamingQuery:
    """Stream documents to the index folders; a repeated batch replaces its files."""
    def write(rows: DataFrame, batch: int) -> None:
        write_index(index_documents(rows, topic, names), f"{path}/batch{batch}")
    writer = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
