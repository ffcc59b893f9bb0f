"""Stream = batch: each streaming form, fed by the ordered replay plus sentinel, gives
the batch result; a restarted stream gives the uninterrupted result (R3)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eddy.operators import checks as C
from eddy.operators import joins as J
from eddy.operators import windows as W
from eddy.plans import queries as Q
from eddy.sources import bindings as B
from eddy.sources import fixtures as FX
from eddy.sources.replay import sentinel_time, write_sentinel, write_slices
from eddy.streaming import queries as SQ
from eddy.streaming import stateful as ST
from eddy.streaming.runner import run_foreach_batch, run_to_memory, run_to_parquet
from eddy.streaming.sinks import latest_per_key, latest_snapshot, upsert_writer


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _replay(spark, batch_df, ts, folder, slice_len, sentinel, start=0, stop=None, with_sentinel=True):
    n = write_slices(batch_df, ts, folder, slice_len, start, stop)
    if with_sentinel:
        write_sentinel(spark, batch_df.schema, folder, {**sentinel, ts: sentinel_time()})
    return n


def _stream(spark, schema, folder):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(os.path.join(folder, "slice-*")))


@pytest.fixture(scope="module")
def bids_ts(spark):
    return B.bids(spark, SF001).select("auction", "bidder", F.col("date_time").cast("timestamp").alias("date_time"),
                                       "event_id")


def test_sliding_count_stream_equals_batch(spark, tmp_path, bids_ts):
    d = str(tmp_path / "bids")
    _replay(spark, bids_ts, "date_time", d, "5 days", {"auction": -1, "bidder": -1, "event_id": -1})
    out = run_to_memory(SQ.sliding_count_stream(_stream(spark, bids_ts.schema, d), "60 minutes", "1 minute"),
                        "w3_stream").filter("auction <> -1")
    batch = Q.q5_sliding_count(spark, SF001)
    assert C.reconcile(batch.withColumn("k", F.concat_ws("|", "auction", "window_start")),
                       out.withColumn("k", F.concat_ws("|", "auction", "window_start")), ["k"], "num").count() == 0
    assert out.count() == batch.count() > 0


def test_sliding_count_sql_stream_equals_batch(spark, tmp_path, bids_ts):
    """Streaming SQL: the Q5 text over a streaming view gives the batch windows."""
    d = str(tmp_path / "bids")
    _replay(spark, bids_ts, "date_time", d, "5 days", {"auction": -1, "bidder": -1, "event_id": -1})
    out = run_to_memory(SQ.sliding_count_sql_stream(_stream(spark, bids_ts.schema, d)), "w3_sql_stream")
    out = out.filter("auction <> -1").select("auction", F.col("window_start").cast("timestamp_ntz"),
                                             F.col("window_end").cast("timestamp_ntz"), "num")
    assert _rows(out) == _rows(Q.QUERIES["q5_sliding_count_sql"](spark, SF001).select("auction", "window_start",
                                                                                      "window_end", "num"))


def test_session_stream_equals_batch(spark, tmp_path, bids_ts):
    d = str(tmp_path / "bids")
    _replay(spark, bids_ts, "date_time", d, "5 days", {"auction": -1, "bidder": -1, "event_id": -1})
    out = run_to_memory(SQ.session_count_stream(_stream(spark, bids_ts.schema, d), Q.Q11_GAP),
                        "w5_stream").filter("bidder <> -1")
    batch = W.session_count(B.bids(spark, SF001), "bidder", "date_time", Q.Q11_GAP, scan=True)
    assert _rows(out) == _rows(batch)


def test_early_session_stream_equals_batch(spark, tmp_path, bids_ts):
    ST.use_rocksdb(spark)
    d = str(tmp_path / "bids")
    _replay(spark, bids_ts, "date_time", d, "5 days", {"auction": -1, "bidder": -1, "event_id": -1})
    s = _stream(spark, bids_ts.schema, d).withWatermark("date_time", "0 seconds")
    out = run_to_memory(ST.early_session_stream(s, 6 * 3600 * 1000, Q.Q11_EARLY_EVERY), "w6_stream")
    out = out.filter("bidder <> -1").select("bidder", F.col("session_start").cast("timestamp_ntz"),
                                            F.col("session_end").cast("timestamp_ntz"), "num", "is_final")
    assert _rows(out) == _rows(Q.q11_session_early(spark, SF001))


def test_window_join_stream_equals_batch(spark, tmp_path):
    ev = B.events(spark, SF001).withColumn("ts", F.col("ts").cast("timestamp"))
    d = str(tmp_path / "events")
    _replay(spark, ev, "ts", d, "5 days", {"event_id": -1, "user_id": -1, "event_type": "sentinel"})
    s = _stream(spark, ev.schema, d).withWatermark("ts", "0 seconds")
    persons = s.filter(F.col("event_type").isin("signup", "sentinel")).select(
        F.col("user_id").alias("id"), F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("ts").alias("date_time"))
    auctions = s.filter(F.col("event_type").isin("purchase", "sentinel")).select(
        F.col("user_id").alias("seller"), F.col("value").alias("reserve"), F.col("ts").alias("date_time"))
    out = run_to_memory(SQ.window_join_stream(persons, auctions, Q.Q8_SIZE), "j4_stream").filter("id <> -1")
    assert _rows(out) == _rows(Q.q8_window_join(spark, SF001))


def _tagged(spark):
    a = FX.repeated_auctions(B.auctions_q3(spark, SF001))
    p = FX.moved_persons(B.persons_q3(spark, SF001))
    return (p.select(F.col("id").alias("k"), "date_time", F.lit(0).alias("side"), F.col("id").alias("rid"), "copy",
                     "name", "city", "state")
             .unionByName(a.select(F.col("seller").alias("k"), "date_time", F.lit(1).alias("side"),
                                   F.col("id").alias("rid"), "copy", F.lit(None).cast("string").alias("name"),
                                   F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("state")))
             .withColumn("date_time", F.col("date_time").cast("timestamp")))


@pytest.mark.parametrize("keep,dedupe,query", [("last", False, "q3_emit_once_last"),
                                                ("last", True, "q3_emit_once_last_set"),
                                                ("first", False, "q3_emit_once_first")])
def test_emit_once_stream_equals_batch(spark, tmp_path, keep, dedupe, query):
    ST.use_rocksdb(spark)
    t = _tagged(spark)
    d = str(tmp_path / "q3")
    _replay(spark, t, "date_time", d, "365 days", {}, with_sentinel=False)
    out = run_to_memory(ST.emit_once_stream(_stream(spark, t.schema, d), keep, dedupe), f"j_{keep}_{dedupe}")
    assert _rows(out) == _rows(Q.QUERIES[query](spark, SF001))


def test_keyed_state_stream_equals_batch(spark, tmp_path, ttl_ms=None):
    ST.use_rocksdb(spark)
    ev = B.keyed_events(spark, SF001).withColumn("event_time", F.col("event_time").cast("timestamp"))
    d = str(tmp_path / "ev")
    _replay(spark, ev, "event_time", d, "3 days", {}, with_sentinel=False)
    changes = run_to_memory(ST.keyed_state_stream(_stream(spark, ev.schema, d), ttl_ms), f"a_states_{ttl_ms}")
    assert _rows(changes.select("key", "sequence_number", "position", "map_entry")) == _rows(
        ev.select("key", "sequence_number", F.col("sequence_number").alias("position"), F.col("payload").alias("map_entry")))
    last = ST.final_from_changes(changes)
    assert _rows(last.select("key", "first_payload", "last_payload")) == _rows(ev.groupBy("key").agg(
        F.min_by("payload", "sequence_number"), F.max_by("payload", "sequence_number")))
    assert changes.count() == ev.count()


def test_restart_equals_uninterrupted(spark, tmp_path, bids_ts):
    """Stop after some slices, resume from the checkpoint, same windows, none twice."""
    d, out, ck = str(tmp_path / "bids"), str(tmp_path / "out"), str(tmp_path / "ck")
    n = write_slices(bids_ts, "date_time", d, "5 days", 0, 3)
    q = SQ.sliding_count_stream(_stream(spark, bids_ts.schema, d), "60 minutes", "1 minute")
    run_to_parquet(q, out, ck)
    first = spark.read.parquet(out).count()
    write_slices(bids_ts, "date_time", d, "5 days", n, None)
    write_sentinel(spark, bids_ts.schema, d, {"auction": -1, "bidder": -1, "event_id": -1,
                                               "date_time": sentinel_time()})
    run_to_parquet(SQ.sliding_count_stream(_stream(spark, bids_ts.schema, d), "60 minutes", "1 minute"), out, ck)
    res = spark.read.parquet(out).filter("auction <> -1")
    assert 0 < first < res.count()
    assert _rows(res) == _rows(Q.q5_sliding_count(spark, SF001))


def test_word_count_stream_update_mode(spark, tmp_path):
    tok = Q._tokens(spark, SF001).select("doc_id", "word")
    d = str(tmp_path / "tok")
    tok.repartitionByRange(4, "doc_id").write.parquet(d)
    s = spark.readStream.schema(tok.schema).option("maxFilesPerTrigger", 1).parquet(d)
    changes = run_to_memory(SQ.word_count_stream(s), "a2_stream", mode="update")
    final = changes.groupBy("word").agg(F.max("n").alias("n"))
    assert _rows(final) == _rows(Q.word_count(spark, SF001))


def test_upsert_stream_equals_batch(spark, tmp_path):
    a = B.auctions_q3(spark, SF001).withColumn("date_time", F.col("date_time").cast("timestamp"))
    d, snap = str(tmp_path / "auc"), str(tmp_path / "snap")
    write_slices(a, "date_time", d, "365 days")
    s = _stream(spark, a.schema, d).select("seller", "id", "reserve", "date_time")
    run_foreach_batch(s, upsert_writer(snap, ["seller"], ["date_time", "id"]), str(tmp_path / "ck"), mode="append")
    got = latest_snapshot(spark, snap).select("seller", "id", "reserve")
    assert _rows(got) == _rows(Q.upsert_latest(spark, SF001))


def test_unbounded_join_stream_equals_batch(spark, tmp_path):
    """Two file streams, inner join without watermark (both sides kept)."""
    a = B.auctions_q3(spark, SF001).withColumn("date_time", F.col("date_time").cast("timestamp"))
    p = B.persons_q3(spark, SF001).withColumn("date_time", F.col("date_time").cast("timestamp"))
    da, dp = str(tmp_path / "a"), str(tmp_path / "p")
    write_slices(a, "date_time", da, "365 days")
    write_slices(p, "date_time", dp, "365 days")
    out = run_to_memory(SQ.join_stream(_stream(spark, a.schema, da), _stream(spark, p.schema, dp)), "j1_stream")
    assert _rows(out) == _rows(Q.q3_join(spark, SF001))


def test_progress_metrics_and_state_reader(spark, tmp_path, bids_ts):
    """K3/K4: latency percentiles and input rates per batch; queryable state (2.13)."""
    from eddy.streaming.sinks import with_latency
    d, out, ck = str(tmp_path / "bids"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_slices(bids_ts, "date_time", d, "10 days")
    q = run_to_parquet(SQ.sliding_count_stream(with_latency(_stream(spark, bids_ts.schema, d), "date_time"),
                                               "60 minutes", "1 minute"), out, ck)
    prog = [p for p in q.recentProgress if p.numInputRows > 0]
    assert prog and all("latency" in p.observedMetrics for p in prog)
    assert sum(p.observedMetrics["latency"]["rows"] for p in prog) == bids_ts.count()
    assert all(p.processedRowsPerSecond >= 0 for p in prog)
    state = ST.read_state(spark, ck)
    assert state.count() > 0


def test_insert_into_table(spark, tmp_path):
    """K6: INSERT INTO ... SELECT * from a view (batch) and from a stream."""
    from eddy.streaming.sinks import create_table, insert_select, insert_stream
    res = Q.q3_join(spark, SF001)
    create_table(spark, "eddy_q3_sink", res, str(tmp_path / "t1"))
    insert_select(spark, "eddy_q3_sink", res, "eddy_q3_view")
    assert _rows(spark.table("eddy_q3_sink")) == _rows(res)
    a = B.auctions_q3(spark, SF001).withColumn("date_time", F.col("date_time").cast("timestamp"))
    d = str(tmp_path / "a")
    write_slices(a, "date_time", d, "365 days")
    create_table(spark, "eddy_auction_sink", a, str(tmp_path / "t2"))
    insert_stream(_stream(spark, a.schema, d), "eddy_auction_sink", str(tmp_path / "ck"))
    assert _rows(spark.table("eddy_auction_sink")) == _rows(a)
    spark.sql("DROP TABLE eddy_q3_sink")
    spark.sql("DROP TABLE eddy_auction_sink")


@pytest.mark.parametrize("mode", ["exactly_once", "at_least_once"])
def test_sequence_check_stream_equals_batch(spark, tmp_path, mode):
    """C1 / C2 on a stream that is stopped half way and resumed, against the batch check."""
    ST.use_rocksdb(spark)
    ev = FX.repeated(FX.gapped(B.keyed_events(spark, SF001))).withColumn("event_time", F.col("event_time").cast("timestamp"))
    d, out, ck = (str(tmp_path / x) for x in ("ev", "out", "ck"))
    n = _replay(spark, ev, "event_time", d, "4 days", {}, with_sentinel=False, stop=4)
    run_to_parquet(ST.sequence_check_stream(_stream(spark, ev.schema, d), mode), out, ck)
    _replay(spark, ev, "event_time", d, "4 days", {}, with_sentinel=False, start=n)
    run_to_parquet(ST.sequence_check_stream(_stream(spark, ev.schema, d), mode), out, ck)
    want = C.sequence_check(FX.repeated(FX.gapped(B.keyed_events(spark, SF001))), mode, Q.ARRIVAL)
    rows = _rows(spark.read.parquet(out))
    assert rows == _rows(want.select("key", "previous", "sequence_number")) and rows


def test_early_sessions_under_disorder(spark, tmp_path, bids_ts):
    """W6 with a bound of two days: slices of one day arrive with neighbours swapped; the
    final sessions equal the batch sessions."""
    ST.use_rocksdb(spark)
    d = str(tmp_path / "bids")
    n = _replay(spark, bids_ts, "date_time", d, "1 day", {"auction": -1, "bidder": -1, "event_id": -1})
    for i in range(0, n - 1, 2):
        a, b = (os.path.join(d, f"slice-{k:06d}") for k in (i, i + 1))
        times = [max(os.path.getmtime(os.path.join(x, f)) for f in os.listdir(x)) for x in (a, b)]
        for x, t in ((a, times[1]), (b, times[0])):
            for f in os.listdir(x):
                os.utime(os.path.join(x, f), (t, t))
    s = _stream(spark, bids_ts.schema, d).withWatermark("date_time", "2 days")
    out = run_to_memory(ST.early_session_stream(s, 6 * 3600 * 1000, Q.Q11_EARLY_EVERY), "w6_disorder")
    final = out.filter("bidder <> -1 and is_final").select(
        "bidder", F.col("session_start").cast("timestamp_ntz"), F.col("session_end").cast("timestamp_ntz"), "num")
    assert _rows(final) == _rows(W.session_count(B.bids(spark, SF001), "bidder", "date_time", Q.Q11_GAP,
                                                 order=["date_time", "event_id"], scan=True))


@pytest.mark.parametrize("keep,query", [("last", "q3_emit_once_last"), ("first", "q3_emit_once_first")])
def test_emit_once_resumes(spark, tmp_path, keep, query):
    """R3 for J2 and J3: waiting auctions and stored persons outlive a stop."""
    ST.use_rocksdb(spark)
    t = _tagged(spark)
    d, out, ck = (str(tmp_path / x) for x in ("q3", "out", "ck"))
    n = write_slices(t, "date_time", d, "900 days", 0, 1)
    run_to_parquet(ST.emit_once_stream(_stream(spark, t.schema, d), keep), out, ck)
    first = spark.read.parquet(out).count()
    write_slices(t, "date_time", d, "900 days", n, None)
    run_to_parquet(ST.emit_once_stream(_stream(spark, t.schema, d), keep), out, ck)
    res = spark.read.parquet(out)
    assert 0 < first < res.count()
    assert _rows(res) == _rows(Q.QUERIES[query](spark, SF001))


def test_upsert_resumes(spark, tmp_path):
    """R3 for K5: the snapshot of a stopped sink goes on."""
    a = B.auctions_q3(spark, SF001).withColumn("date_time", F.col("date_time").cast("timestamp"))
    d, snap, ck = (str(tmp_path / x) for x in ("auc", "snap", "ck"))
    n = write_slices(a, "date_time", d, "900 days", 0, 1)
    for start in (None, n):
        if start is not None:
            write_slices(a, "date_time", d, "900 days", start, None)
        s = _stream(spark, a.schema, d).select("seller", "id", "reserve", "date_time")
        run_foreach_batch(s, upsert_writer(snap, ["seller"], ["date_time", "id"]), ck, mode="append")
    assert _rows(latest_snapshot(spark, snap).select("seller", "id", "reserve")) == _rows(Q.upsert_latest(spark, SF001))


def test_early_sessions_resume(spark, tmp_path, bids_ts):
    """R3 for W6: open sessions, their counts and timers outlive a stop."""
    ST.use_rocksdb(spark)
    d, out, ck = (str(tmp_path / x) for x in ("bids", "out", "ck"))
    sentinel = {"auction": -1, "bidder": -1, "event_id": -1}

    def run():
        s = _stream(spark, bids_ts.schema, d).withWatermark("date_time", "0 seconds")
        run_to_parquet(ST.early_session_stream(s, 6 * 3600 * 1000, Q.Q11_EARLY_EVERY), out, ck)

    n = _replay(spark, bids_ts, "date_time", d, "5 days", sentinel, 0, 3, with_sentinel=False)
    run()
    first = spark.read.parquet(out).count()
    _replay(spark, bids_ts, "date_time", d, "5 days", sentinel, n, None)
    run()
    res = spark.read.parquet(out).filter("bidder <> -1")
    assert 0 < first < res.count()
    res = res.select("bidder", F.col("session_start").cast("timestamp_ntz"),
                     F.col("session_end").cast("timestamp_ntz"), "num", "is_final")
    assert _rows(res) == _rows(Q.q11_session_early(spark, SF001))
