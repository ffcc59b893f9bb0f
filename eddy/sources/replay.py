"""Replay a table as an ordered stream of files, plus the end-of-input sentinel.

The file source takes files oldest first; with ``maxFilesPerTrigger=1`` every time slice
becomes one micro-batch, so event time only moves forward between batches and
zero-lateness windows lose nothing. A final sentinel row far in the future moves the
watermark past the last open windows. Resuming from a checkpoint continues after the
last committed file (S9): offsets live in the checkpoint, not in user code.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import file_system

# Fixed value: time of the sentinel row that closes every open window.
SENTINEL_TIME = "2100-01-01 00:00:00"


def slice_ids(df: DataFrame, ts: str, slice_len: str) -> list:
    """Distinct slice starts (one small aggregate: one row per slice)."""
    return sorted(r[0] for r in df.select(F.window(ts, slice_len).start.alias("s")).distinct().collect())


def write_slices(df: DataFrame, ts: str, out_dir: str, slice_len: str = "1 day",
                 start: int = 0, stop: int | None = None) -> int:
    """Write slices ``start:stop`` of ``df`` in time order, one folder each, with rising
    modification times. Returns the number of slices written. Rows without a time are in
    no slice.

    One job for all slices: rows are dealt to ranges of (slice, time) and written
    partitioned by slice; the folders are then renamed and dated in order."""
    starts = slice_ids(df.filter(F.col(ts).isNotNull()), ts, slice_len)
    sel = starts[start:stop]
    if not sel:
        return 0
    spark = df.sparkSession
    number = F.unix_seconds(F.window(ts, slice_len).start.cast("timestamp"))
    staged = f"{out_dir}/_staged-{start:06d}"
    first, last = (int(_seconds(spark, s)) for s in (sel[0], sel[-1]))
    rows = df.withColumn("_slice", number).filter(F.col("_slice").between(first, last))
    rows.repartitionByRange("_slice", ts).sortWithinPartitions("_slice", ts).write.partitionBy("_slice").parquet(staged)
    fs, p = file_system(spark, staged)
    folders = sorted((s.getPath() for s in fs.listStatus(p) if s.isDirectory()),
                     key=lambda q: int(q.getName().removeprefix("_slice=")))
    base = time.time() - 10_000 + start
    for i, folder in enumerate(folders):
        path = f"{out_dir}/slice-{start + i:06d}"
        fs.rename(folder, file_system(spark, path)[1])
        _touch(spark, path, base + i)
    fs.delete(p, True)
    return len(sel)


def _seconds(spark, start) -> int:
    """Unix seconds of a slice start (session time zone)."""
    return spark.range(1).select(F.unix_seconds(F.lit(start).cast("timestamp"))).first()[0]


def write_sentinel(spark, schema, out_dir: str, values: dict) -> None:
    """One row in the far future on this input (``values`` fills the other columns)."""
    row = {f.name: values.get(f.name) for f in schema.fields}
    df = spark.createDataFrame([row], schema)
    path = f"{out_dir}/slice-zzzzzz-sentinel"
    df.coalesce(1).write.mode("overwrite").parquet(path)
    _touch(spark, path, time.time())


def _touch(spark, path: str, t: float) -> None:
    """Date the files of a folder, on whatever store holds it."""
    fs, p = file_system(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        fs.setTimes(files.next().getPath(), int(t * 1000), -1)


def sentinel_time():
    import datetime as dt
    return dt.datetime.fromisoformat(SENTINEL_TIME)
