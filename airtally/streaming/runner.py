"""Starting several streaming queries, waiting for them, and keeping their results."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airtally.operators.changes import latest_by_key
from airtally.session import state_partitions

ALL_THERE_IS = {"availableNow": True}


@dataclass(frozen=True)
class Live:
    """One streaming query to run: its rows, output mode and trigger.

    ``step`` is applied to each micro-batch as a table, for plans that depend on the batch's data,
    such as a join that spreads the batch's heavy keys or reads the newest version of a table.
    """

    name: str
    rows: DataFrame
    mode: str = "append"
    trigger: dict | None = None
    step: Callable[[DataFrame], DataFrame] | None = None

    def schema(self) -> T.StructType:
        if self.step is None:
            return self.rows.schema
        return self.step(self.rows.sparkSession.createDataFrame([], self.rows.schema)).schema


def table_sink(live: Live, folder: str) -> StreamingQuery:
    """Write every micro-batch to its own folder. A batch repeated after a failure
    replaces its folder, so each batch counts once, in any output mode.

    A query takes its settings when it starts and keeps the number of state partitions of its first run."""
    def keep(rows: DataFrame, batch: int) -> None:
        result = live.step(rows) if live.step else rows
        result.write.mode("overwrite").parquet(f"{folder}/{live.name}/rows/batch={batch}")
    conf, partitions = live.rows.sparkSession.conf, "spark.sql.shuffle.partitions"
    asked = conf.get(partitions)
    conf.set(partitions, str(state_partitions(live.rows.sparkSession)))
    try:
        return (live.rows.writeStream.queryName(live.name).outputMode(live.mode).foreachBatch(keep)
                .option("checkpointLocation", f"{folder}/{live.name}/checkpoint")
                .trigger(**(live.trigger or ALL_THERE_IS)).start())
    finally:
        conf.set(partitions, asked)


def kept(live: Live, folder: str, keys: list[str] | None = None) -> DataFrame:
    """What a finished ``table_sink`` stands for: all rows in append mode, the last
    batch in complete mode, the latest row per key in update mode (all rows when
    no keys are given)."""
    spark = live.rows.sparkSession
    schema = T.StructType([*live.schema().fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{folder}/{live.name}/rows")
    if live.mode == "complete":
        newest = rows.agg(F.max("batch").alias("batch"))  # one row
        return rows.join(F.broadcast(newest), "batch", "left_semi").drop("batch")
    if live.mode == "update" and keys:
        return latest_by_key(rows, keys, ["batch"]).drop("batch")
    return rows.drop("batch")


def run_queries(spark: SparkSession, starts: dict[str, Callable[[], StreamingQuery]],
                timeout: float) -> dict[str, str]:
    """Start named queries and wait until all have ended or ``timeout`` seconds are
    over; then stop the rest. Returns ``finished``, ``stopped`` or the error."""
    running = {name: start() for name, start in starts.items()}
    deadline = time.monotonic() + timeout
    state = {}
    for name, query in running.items():
        try:
            done = query.awaitTermination(max(0.0, deadline - time.monotonic()))
            state[name] = "finished" if done else "stopped"
        except Exception as failure:  # one failed query must not hide the others
            state[name] = f"failed: {failure}"
        finally:
            if query.isActive:
                query.stop()
    spark.streams.resetTerminated()
    return state
