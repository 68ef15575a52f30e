"""The latest row of each key of a change stream, kept as a table that grows by micro-batches.

Every micro-batch writes its own latest rows as a delta, and every ``merge_every`` batches the
deltas since then are merged into a new version of the whole table. A batch never touches the
changes of earlier ones. Folders are named by batch, so a batch repeated after a failure replaces
what it wrote, and count only when they are complete. The version before the newest one and
its deltas stay, so that a reader which began with it can end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airtally.operators.changes import latest_by_key
from airtally.streaming.runner import ALL_THERE_IS

DELTA, VERSION = "delta", "version"


def _complete(spark: SparkSession, folder: str, kind: str) -> list[int]:
    """Batches with a finished folder of one kind, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}/batch=*/_SUCCESS")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in files or ())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def latest_table(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], order: list[str],
                 before: int | None = None) -> DataFrame:
    """The table as of now, or as of the batches before ``before``; empty when nothing came yet.

    Reads the newest version and the deltas after it. Without such deltas nothing is aggregated.
    """
    def known(kind: str) -> list[int]:
        return [b for b in _complete(spark, folder, kind) if before is None or b < before]

    versions = known(VERSION)
    newest = versions[-1] if versions else -1
    deltas = [f"{folder}/{DELTA}/batch={b}" for b in known(DELTA) if b > newest]
    if not versions and not deltas:
        return spark.createDataFrame([], schema)
    base = [f"{folder}/{VERSION}/batch={newest}"] if versions else []
    rows = spark.read.schema(schema).parquet(*base, *deltas)
    return latest_by_key(rows, keys, order) if deltas else rows


def keep_latest(changes: DataFrame, folder: str, keys: list[str], order: list[str], merge_every: int = 4,
                trigger: dict | None = None) -> StreamingQuery:
    """Start keeping the latest row of ``keys``, by ``order``, of a change stream in ``folder``.

    Changes may come late or twice: the greatest ``order`` counts, not the last to come. Rows of a null
    key are one key. With ``merge_every`` 1 readers find whole versions only.
    """
    spark, schema = changes.sparkSession, changes.schema

    def keep(rows: DataFrame, batch: int) -> None:
        latest_by_key(rows, keys, order).write.mode("overwrite").parquet(f"{folder}/{DELTA}/batch={batch}")
        if (batch + 1) % merge_every == 0:
            known = latest_table(rows.sparkSession, folder, schema, keys, order, before=batch)
            fresh = rows.sparkSession.read.schema(schema).parquet(f"{folder}/{DELTA}/batch={batch}")
            merged = latest_by_key(known.unionByName(fresh), keys, order)
            merged.write.mode("overwrite").parquet(f"{folder}/{VERSION}/batch={batch}")
            forget(batch - merge_every)

    def forget(until: int) -> None:
        """Delete the versions before ``until`` and the deltas that this one holds."""
        for kind, last in ((VERSION, until - 1), (DELTA, until)):
            for batch in _complete(spark, folder, kind):
                if batch <= last:
                    _delete(spark, f"{folder}/{kind}/batch={batch}")

    return (changes.writeStream.outputMode("append").foreachBatch(keep)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(**(trigger or ALL_THERE_IS)).start())
