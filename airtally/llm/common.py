"""Helpers the text operators share: tables, folds, bounded samples, Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text handled at a time where a text is cut for bounded memory.
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One output batch for each Arrow batch with rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)
    return df.mapInArrow(run, schema)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                  per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents of each class.

    The rows with the smallest hashes of their ids are taken, never one of the held-out
    fold. Labels other than 0 and 1 and null ids are left out; a repeated id counts once,
    with its largest label and text.
    """
    known = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                    & ~in_fold(F.col("doc_id"), folds, fold))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    picked = [known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
              for value in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    # At most 2 * per_class ids, so the broadcast has a fixed bound.
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "label").agg(F.max("text").alias("text"))
            .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label"))


def fit_in_one_task(rows: DataFrame, fit: Callable[[list[str], np.ndarray], list[bytes]]) -> list[bytes]:
    """Fit a model on a bounded sample in one task; returns the model's arrays as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for batch in batches for row in batch.to_pylist()]
        found.sort(key=lambda row: row["doc_id"])
        parts = fit([row["text"] for row in found], np.array([row["label"] for row in found], np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([parts], pa.list_(pa.binary()))], ["parts"])
    model = rows.coalesce(1).mapInArrow(run, "parts array<binary>").first()
    if model is None:  # no partition at all, so no task
        return fit([], np.zeros(0, np.int64))
    return [bytes(part) for part in model["parts"]]


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def sigmoid(z: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0))))
