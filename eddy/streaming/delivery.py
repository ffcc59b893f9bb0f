"""Streams run by their parameters: delivery modes (R1), what becomes of checkpoints (R2),
state store and partitions (R6, R7), idle inputs (T4), dropped rows and event time (T5).

A plain sink (files written by a batch function) repeats a batch whose query stopped
between the sink's write and Spark's commit. With a ledger it doesn't: every attempt
writes to a folder of its own and then enters its name for the batch; a batch that is
entered is skipped, and readers go by the entries. Without it (``at_least_once``) readers
take every finished attempt, so a repeated batch shows up again, and nothing is lost.

An entry is one empty file, made after the attempt's data is complete; a stop in between
leaves an attempt that no reader sees. One driver runs a query at a time, which is what
Spark's own checkpoint asks for too.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..config import Params, stream_conf, trigger_kwargs
from ..scratch import delete, file_system


def plain_sink(path: str, mode: str):
    """A ``foreachBatch`` function that writes batches below ``path`` in delivery ``mode``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if mode == "exactly_once" and _found(spark, f"{path}/ledger/{batch_id:012d}-*"):
            return
        attempt = uuid.uuid4().hex
        batch.write.parquet(_attempt(path, batch_id, attempt))
        if mode == "exactly_once":
            fs, entry = file_system(spark, f"{path}/ledger/{batch_id:012d}-{attempt}")
            fs.create(entry, False).close()
    return write


def delivered(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """The rows of a plain sink: those of the entered attempts, or of every finished one."""
    if mode == "exactly_once":
        names = [p.rsplit("/", 1)[1].split("-") for p in _found(spark, f"{path}/ledger/*-*")]
        folders = [_attempt(path, int(batch), attempt) for batch, attempt in names]
    else:
        folders = [p.rsplit("/", 1)[0] for p in _found(spark, f"{path}/data/*/_SUCCESS")]
    if not folders:
        raise ValueError(f"{path} holds no delivered batch")
    return spark.read.parquet(*sorted(folders))


def _attempt(path: str, batch_id: int, attempt: str) -> str:
    return f"{path}/data/{batch_id:012d}-{attempt}"


def _found(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or []]


@contextmanager
def settings(spark: SparkSession, p: Params):
    """The session with the stream settings of ``p``; a query keeps those it was started
    with, so the caller's are put back."""
    new = stream_conf(p)
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start(df: DataFrame, write, p: Params, checkpoint: str, mode: str = "append", all_now: bool = False,
          name: str | None = None):
    """The running query of ``df`` into the batch function ``write``: one micro-batch per
    checkpoint interval, or ``all_now``: what is there, then the end."""
    w = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if all_now else w.trigger(**trigger_kwargs(p))
    with settings(df.sparkSession, p):
        return (w.queryName(name) if name else w).start()


def finish(query, p: Params, checkpoint: str):
    """Wait for the end of ``query`` (or end it, if it runs by intervals, when the rows that
    are there are through). Its checkpoint goes unless ``p`` keeps it; that of a failed
    query always stays, since resuming is what it is for."""
    if query.isActive:
        query.processAllAvailable()
        query.stop()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    if not p.keep_checkpoints:
        delete(SparkSession.active(), checkpoint)


class StreamMetrics(StreamingQueryListener):
    """Gathers, per query id, the last watermark, input rows and the rows that stateful
    operators dropped because they were behind it. Add it with ``spark.streams.addListener``.
    It keeps sums, not the reports, however long a query runs."""

    def __init__(self):
        self.queries: dict[str, dict] = {}

    def onQueryStarted(self, event) -> None:
        self.queries.setdefault(str(event.id), {"rows": 0, "dropped": 0, "batches": 0, "watermark": None, "ended": False})

    def onQueryProgress(self, event) -> None:
        self.add(json.loads(event.progress.json))

    def add(self, progress: dict) -> None:
        q = self.queries.setdefault(progress["id"], {"rows": 0, "dropped": 0, "batches": 0, "watermark": None, "ended": False})
        q["rows"] += max(0, progress.get("numInputRows", 0))
        q["dropped"] += sum(s.get("numRowsDroppedByWatermark", 0) for s in progress.get("stateOperators", []))
        q["batches"] += 1
        q["watermark"] = progress.get("eventTime", {}).get("watermark", q["watermark"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) in self.queries:
            self.queries[str(event.id)]["ended"] = True
