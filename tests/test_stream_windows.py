"""Windows closed and checked on streams: equal to the batch forms after a stop and a resume."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eddy.operators import checks as C
from eddy.operators import windows as W
from eddy.plans import queries as Q
from eddy.sources import bindings as B
from eddy.sources import fixtures as FX
from eddy.sources.replay import sentinel_time, write_sentinel, write_slices
from eddy.streaming import stateful as ST
from eddy.streaming import windows as SW
from eddy.streaming.runner import run_to_parquet


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(folder, "slice-*"))


def stopped_and_resumed(spark, tmp_path, df, ts, slice_len, sentinel, build, name):
    """``build``'s stream over ``df``, stopped after half of the slices and resumed; the rows
    its sink holds, and how many it held at the stop."""
    ST.use_rocksdb(spark)
    d, out, ck = (str(tmp_path / f"{name}-{x}") for x in ("in", "out", "ck"))
    n = write_slices(df, ts, d, slice_len, 0, 2)
    run_to_parquet(build(_stream(spark, df.schema, d)), out, ck)
    at_stop = spark.read.parquet(out).count()
    write_slices(df, ts, d, slice_len, n, None)
    write_sentinel(spark, df.schema, d, {**sentinel, ts: sentinel_time()})
    run_to_parquet(build(_stream(spark, df.schema, d)), out, ck)
    return spark.read.parquet(out).filter("key <> -1"), at_stop


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def events(spark):
    return B.keyed_events(spark, SF001).withColumn("event_time", F.col("event_time").cast("timestamp"))


END = {"key": -1, "sequence_number": -1, "event_id": -1}


def test_sliding_collect_stream_equals_batch(spark, tmp_path, events, part=2):
    def build(s):
        return SW.window_members_stream(s.withWatermark("event_time", "0 seconds"), Q.SLIDE_MS * Q.SLIDE_FACTOR, Q.SLIDE_MS, part)

    got, at_stop = stopped_and_resumed(spark, tmp_path, events, "event_time", "10 days", END, build, f"w4-{part}")
    want = W.sliding_collect(events, "key", "event_time", Q.SIZE, Q.SLIDE, "sequence_number", "payload", part)
    assert 0 < at_stop < got.count()
    assert _rows(SW.collected(got)) == _rows(want)


def test_members_wait_out_of_order(spark, tmp_path, events):
    """Within the watermark's bound, slices may come in any order."""
    d, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    n = write_slices(events, "event_time", d, "2 days")
    for i in range(0, n - 1, 2):
        a, b = (os.path.join(d, f"slice-{k:06d}") for k in (i, i + 1))
        for x, t in ((a, 2 * i + 1), (b, 2 * i)):
            for f in os.listdir(x):
                os.utime(os.path.join(x, f), (1_000_000_000 + t, 1_000_000_000 + t))
    write_sentinel(spark, events.schema, d, {**END, "event_time": sentinel_time()})
    ST.use_rocksdb(spark)
    s = _stream(spark, events.schema, d).withWatermark("event_time", "4 days")
    run_to_parquet(SW.window_members_stream(s, 7_200_000, 3_600_000, 3), out, ck)
    got = SW.collected(spark.read.parquet(out).filter("key <> -1"))
    assert _rows(got) == _rows(W.sliding_collect(events, "key", "event_time", "2 hours", "1 hour", "sequence_number", "payload", 3))


def test_tumbling_close_equals_batch(spark, tmp_path, events):
    """With one slide as the size, every element once, when its window closes."""
    hours = 24 * 3_600_000
    got, at_stop = stopped_and_resumed(
        spark, tmp_path, events, "event_time", "10 days", END,
        lambda s: SW.window_members_stream(s.withWatermark("event_time", "0 seconds"), hours, hours), "w1")
    want = W.tumbling_pass(events, "event_time", "1 day").select("key", "window_start", "window_end", "sequence_number", "payload")
    got = got.select("key", F.col("window_start").cast("timestamp_ntz"), F.col("window_end").cast("timestamp_ntz"),
                     "sequence_number", "payload")
    assert 0 < at_stop < got.count() and _rows(got) == _rows(want)


def _alerts(members):
    """The four batch checks in the stream's columns."""
    ntz = F.col("window_start").cast("timestamp")
    none = F.lit(None).cast("long")
    c3 = C.window_contiguity(members).select(F.lit("contiguity"), "key", ntz, "sequence_number", F.col("previous"))
    c4 = C.missed_window(members, Q.SLIDE_FACTOR).select(
        F.lit("missed_window"), "key", F.col("missed_window").cast("timestamp"), "sequence_number", "seen")
    c5 = C.seen_too_often(members, Q.SLIDE_FACTOR).select(F.lit("seen_too_often"), "key", ntz, "sequence_number", none)
    c6 = C.sequence_went_back(members).select(F.lit("sequence_back"), "key", ntz, "last_sequence", "seen_so_far")
    return c3.unionAll(c4).unionAll(c5).unionAll(c6)


DAY_MS = 24 * 3_600_000


@pytest.mark.parametrize("part", [3, 1000])
def test_window_checks_stream_equals_batch(spark, tmp_path, part):
    """Windows of three days over gapped events, some dropped, some added: all four alerts."""
    ev = FX.gapped(B.keyed_events(spark, SF001)).select("key", "event_time", "sequence_number")
    members = FX.extra_window(FX.drop_window(W.sliding_members(ev, "event_time", "3 days", "1 day")), DAY_MS, 3 * DAY_MS)
    m = members.select("key", F.col("window_start").cast("timestamp").alias("window_start"),
                       (F.col("window_start").cast("timestamp") + F.expr("INTERVAL 3 days")).alias("window_end"), "sequence_number")
    got, at_stop = stopped_and_resumed(
        spark, tmp_path, m, "window_end", "10 days", {"key": -1, "sequence_number": -1, "window_start": sentinel_time()},
        lambda s: SW.window_checks_stream(s.withWatermark("window_end", "0 seconds"), Q.SLIDE_FACTOR, part), "checks")
    rows = _rows(got.select("check", "key", "window_start", "sequence_number", "other"))
    assert rows == _rows(_alerts(members))
    assert {r[0] for r in rows} == {"contiguity", "missed_window", "seen_too_often", "sequence_back"} and 0 < at_stop < len(rows)


def test_user_trigger_and_aggregate_on_sliding_windows(spark, tmp_path, events):
    """Fire after every second element and at the close; a purging trigger starts anew."""
    class Extremes(SW.Aggregate):
        """A user's aggregate: number, least and largest sequence number."""

        state = "num long, low long, high long"
        result = "num long, low long, high long"

        def create(self):
            return [0, 2 ** 62, -1]

        def add(self, acc, row):
            return [acc[0] + 1, min(acc[1], row.sequence_number), max(acc[2], row.sequence_number)]

        def merge(self, a, b):
            return [a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])]

        def value(self, acc):
            return tuple(acc)

    for purge in (False, True):
        got, _ = stopped_and_resumed(
            spark, tmp_path, events, "event_time", "10 days", END,
            lambda s: SW.keyed_windows_stream(s.withWatermark("event_time", "0 seconds"), "key", "event_time",
                                              SW.Sliding(48 * 3_600_000, 24 * 3_600_000), SW.EveryElements(2, purge), Extremes(),
                                              ["event_time", "event_id"]), f"trigger-{purge}")
        want = {}
        for r in W.sliding_members(events, "event_time", "48 hours", "24 hours").collect():
            want.setdefault((r["key"], r["window_start"]), []).append((r["event_time"], r["event_id"], r["sequence_number"]))
        expected = []
        for (key, start), elements in want.items():
            seqs = [e[2] for e in sorted(elements)]
            held = []
            for n, s in enumerate(seqs, 1):
                held.append(s)
                if n % 2 == 0:
                    expected.append((key, start, len(held), min(held), max(held), False))
                    held = [] if purge else held
            expected.append((key, start, len(held), min(held, default=2 ** 62), max(held, default=-1), True))
        rows = got.select("key", F.col("window_start").cast("timestamp_ntz"), "num", "low", "high", "is_final")
        assert _rows(rows) == sorted(expected, key=str)
