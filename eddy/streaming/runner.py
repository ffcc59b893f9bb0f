"""Running streaming queries to completion (``availableNow``) with checkpoints.

Checkpoints go under the session's ``spark.checkpoint.dir`` (the shared folder the
cluster names); a restart with the same name resumes where the last run stopped.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


def run_to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """K2 in tests: run all available input into a memory table and return it.

    The memory sink cannot resume, so each run gets its own checkpoint folder."""
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
           .option("checkpointLocation", checkpoint or checkpoint_for(spark, f"{name}-{uuid.uuid4().hex}"))
           .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.table(name)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, partition_by: list[str] | None = None):
    """K6 / streaming file sink: append-only, exactly-once through the sink's commit log.
    Returns the finished query (its ``recentProgress`` holds the K3/K4 metrics)."""
    w = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "update"):
    """Run with a ``foreachBatch`` writer (idempotent writers give exactly-once)."""
    q = (df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def discard(df: DataFrame, checkpoint: str, mode: str = "append"):
    """K1: accept and drop (the ``noop`` sink)."""
    q = (df.writeStream.format("noop").outputMode(mode).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
