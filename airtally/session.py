"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings. Skewed join partitions are split by AQE while the job runs;
# the RocksDB store keeps keyed state off the heap (transformWithState needs it).
# A micro-batch commits what changed in each store as a log, and a join of streams has one store
# for each partition in place of four.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def build_session(app: str = "airtally", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, the bench and local work. On a cluster spark-submit
    supplies the master, the sizes and ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built.

    On one machine Spark's default of 200 shuffle partitions means 200 state stores
    per join of a stream, so there it becomes the number of cores. A cluster keeps
    what it was given.
    """
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    partitions = "spark.sql.shuffle.partitions"
    if spark.sparkContext.master.startswith("local") and spark.conf.get(partitions) == "200":
        spark.conf.set(partitions, str(spark.sparkContext.defaultParallelism))
    return spark


def state_partitions(spark: SparkSession) -> int:
    """Partitions for the state of a new streaming query: a store costs each micro-batch the same however few
    rows it gets, and state lies on disk, so no more than there are cores, nor than was asked for."""
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="airtally-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """The DataFrame as a Parquet table in the shared folder, computed once.

    Cuts the lineage of a result that several later steps read: they scan a table
    instead of repeating its joins, a lost executor costs only a scan, and Spark
    knows the table's size when it picks joins.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``written`` made, once nothing reads it any more."""
    files = table.inputFiles()
    if files:
        spark = table.sparkSession
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values without a zone, as other engines read them."""
    return df.select([
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
