"""Intermediate tables in the folder that driver and executors share.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and reading it
back. A lost executor then costs a re-read, never a recomputation of what came before,
and the exchanges of a later join stay plain ones that adaptive execution can split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import checkpoint_dir


class Scratch:
    """Tables of one query run, each in a folder of its own below the shared folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/eddy-{name}-{uuid.uuid4().hex}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the table read back (same schema)."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._eddy_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in tables:
            delete(self.spark, df._eddy_path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path: works on any store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
