"""Settings that act: delivery modes found by the sequence checks, checkpoints kept or
deleted, state partitions, idle inputs, dropped rows."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eddy.config import Params
from eddy.operators.checks import sequence_check
from eddy.operators.timing import late_rows
from eddy.sources import bindings as B
from eddy.streaming import delivery as D
from eddy.streaming import sinks
from eddy.sources import messages as M

from conftest import SF001

P = Params(max_parallelism=3)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("mode", ["exactly_once", "at_least_once"])
def test_a_repeated_batch_shows_up_by_delivery_mode(spark, tmp_path, mode):
    """The query stops after a batch is written and before it is committed, twice: once with
    the batch delivered, once in the middle of an attempt."""
    ev = B.keyed_events(spark, SF001).select("key", "sequence_number")
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for k in range(3):
        ev.where(F.col("sequence_number") % 3 == k).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    write, stops = D.plain_sink(out, mode), [1, 2]

    def stopping(batch, batch_id):
        if stops == [2] and batch_id == 2:
            batch.write.parquet(f"{out}/data/{batch_id:012d}-halfway")
            os.remove(f"{out}/data/{batch_id:012d}-halfway/_SUCCESS")
            stops.pop()
            raise RuntimeError("lost")
        write(batch, batch_id)
        if stops and stops[0] == batch_id:
            stops.pop(0)
            raise RuntimeError("lost")

    p = Params(max_parallelism=3, checkpoint_mode=mode)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            D.finish(D.start(stream, stopping, p, ck, all_now=True), p, ck)
    D.finish(D.start(stream, stopping, p, ck, all_now=True), p, ck)
    got = D.delivered(spark, out, p.checkpoint_mode)
    alerts = sequence_check(got, mode, ["sequence_number"])
    assert got.distinct().count() == ev.count() and sequence_check(got, "at_least_once", ["sequence_number"]).isEmpty()
    if mode == "exactly_once":
        assert _rows(got) == _rows(ev) and alerts.isEmpty()
    else:
        again = got.count() - ev.count()
        assert again == ev.where(F.col("sequence_number") % 3 == got.groupBy("key", "sequence_number").count().where("count > 1")
                                 .first()["sequence_number"] % 3).count() > 0
        assert sequence_check(got, "exactly_once", ["sequence_number"]).count() == again


@pytest.mark.parametrize("keep", [True, False])
def test_settings_act_and_leave_the_session_alone(spark, tmp_path, keep):
    src, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    spark.range(100).select((F.col("id") % 7).alias("k")).write.parquet(src)
    p = Params(max_parallelism=3, state_store="rocks", incremental=True, keep_checkpoints=keep, checkpoint_interval_ms=200)
    before = {k: spark.conf.get(k, None) for k in D.stream_conf(p)}
    kept = {}

    def write(batch, _):
        kept.update({r["k"]: r["n"] for r in batch.collect()})

    counts = spark.readStream.schema("k long").parquet(src).groupBy("k").agg(F.count("*").alias("n"))
    q = D.start(counts, write, p, ck, mode="update", name="settings")
    assert q.name == "settings"
    q.processAllAvailable()
    state = q.lastProgress["stateOperators"][0]
    D.finish(q, p, ck)
    assert sum(kept.values()) == 100 and len(kept) == 7
    assert state["numShufflePartitions"] == 3 and any(k.startswith("rocksdb") for k in state["customMetrics"])
    assert {k: spark.conf.get(k, None) for k in before} == before
    assert os.path.exists(ck) == keep


@pytest.fixture
def metrics(spark):
    m = D.StreamMetrics()
    spark.streams.addListener(m)
    yield m
    spark.streams.removeListener(m)


T0 = datetime(2024, 1, 1)


def _write(spark, folder, minutes):
    rows = [(i, T0 + timedelta(minutes=m)) for i, m in minutes]
    spark.createDataFrame(rows, "id long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("hold", [True, False])
def test_a_silent_input_holds_time_back_or_not(spark, tmp_path, hold):
    """Two inputs, one silent after its first row: its event time decides, or the other's."""
    a, b, out, ck = (str(tmp_path / x) for x in ("a", "b", "out", "ck"))
    p = Params(max_parallelism=2, idle_inputs_hold_time=hold)
    _write(spark, b, [(100, 1)])
    for step in range(3):
        _write(spark, a, [(step, 20 * step + 1)])
        one, two = (spark.readStream.schema("id long, ts timestamp").parquet(x).withWatermark("ts", "0 minutes") for x in (a, b))
        n = one.union(two).groupBy(F.window("ts", "10 minutes")).agg(F.count("*").alias("n")).select("window.start", "n")
        D.finish(D.start(n, D.plain_sink(out, "exactly_once"), p, ck, all_now=True), p, ck)
    closed = _rows(D.delivered(spark, out, "exactly_once"))
    assert closed == ([] if hold else [(T0, 2), (T0 + timedelta(minutes=20), 1)])


def test_dropped_rows_equal_the_late_report(spark, tmp_path, metrics):
    """Arrivals one run apart, so that the stream's watermark has followed each of them."""
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    minutes = [5, 30, 10, 31, 29, 60, 59, 70]
    for i, m in enumerate(minutes):
        _write(spark, src, [(i, m)])
        s = spark.readStream.schema("id long, ts timestamp").parquet(src).withWatermark("ts", "0 minutes")
        q = D.start(s.dropDuplicates(["id", "ts"]), D.plain_sink(out, "exactly_once"), P, ck, all_now=True)
        D.finish(q, P, ck)
    table = spark.createDataFrame([(i, T0 + timedelta(minutes=m)) for i, m in enumerate(minutes)], "id long, ts timestamp")
    late = late_rows(table.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "ts", ["id"])
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    got = metrics.queries[str(q.id)]
    assert got["dropped"] == late.count() == 3 and got["rows"] == len(minutes)
    assert got["watermark"] == "2024-01-01T01:10:00.000Z" and got["ended"]
    assert sorted(r.id for r in D.delivered(spark, out, "exactly_once").collect()) == [0, 1, 3, 5, 7]


def test_upsert_messages_read_back(spark):
    orders = B.auctions_q3(spark, SF001)
    msgs = sinks.to_message(orders, "id").select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    back = M.decode_checked(msgs, orders.schema)
    assert back.where("broken is not null or msg_key <> id").isEmpty()
    assert _rows(back.select(*orders.columns)) == _rows(orders)
