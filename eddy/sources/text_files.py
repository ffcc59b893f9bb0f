"""Text files as a source of numbered lines.

A file may be read in splits by many tasks, so a line's number is the count of lines in
the file's earlier splits (one small row per split, summed along the file) plus its place
in its own split. The numbers don't depend on how files are split. Files that vanish
between listing and reading are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, line_no (from 1), value of every line of the files."""
    raw = spark.read.option("ignoreMissingFiles", "true").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), "value")
    split = raw.groupBy("path", "split").agg(F.count(F.lit(1)).alias("many"))
    before = keyed_running(split, ["path"], ["split"], {"upto": ("sum", F.col("many"))})
    before = before.select("path", "split", (F.col("upto") - F.col("many")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("path", "split").orderBy("at"))  # a split's lines
    numbered = raw.withColumn("inside", inside).join(before, ["path", "split"])
    return numbered.select("path", (F.col("before") + F.col("inside")).cast("bigint").alias("line_no"), "value")


def lines_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """path and value of every line of files as they arrive (streaming). Lines have no
    numbers: those need the whole file."""
    r = spark.readStream.option("ignoreMissingFiles", "true")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.text(folder).select(F.col("_metadata.file_path").alias("path"), "value")
