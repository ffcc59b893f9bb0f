"""User folds on streams equal the batch states after a stop and a resume, and carry over
into a changed query."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from eddy.operators import aggregates as A
from eddy.sources import bindings as B
from eddy.sources.replay import write_slices
from eddy.streaming import folds as FO
from eddy.streaming import stateful as ST
from eddy.streaming.runner import run_to_parquet
from test_stream_windows import _rows, _stream, few_partitions  # noqa: F401

PART = 4
TAG = "keyed_state_generic"


@pytest.fixture(scope="module")
def events(spark):
    return B.keyed_events(spark, SF001).withColumn("event_time", F.col("event_time").cast("timestamp"))


def _resumed(spark, tmp_path, events, build):
    """``build``'s stream stopped after the first slice and resumed."""
    ST.use_rocksdb(spark)
    d, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    n = write_slices(events, "event_time", d, "10 days", 0, 1)
    run_to_parquet(build(_stream(spark, events.schema, d)), out, ck)
    write_slices(events, "event_time", d, "10 days", n, None)
    run_to_parquet(build(_stream(spark, events.schema, d)), out, ck)
    return spark.read.parquet(out), ck


CASES = {
    "first": (FO.FIRST, None, lambda e: A.final_first(e), "payload"),
    "last": (FO.LAST, None, lambda e: A.final_last(e), "payload"),
    "concat": (FO.CONCAT, PART, lambda e: A.final_concat(e, part_events=PART).select("key", "part", "state"), "state"),
    "list": (FO.ITEMS, PART, lambda e: A.final_list(e, part_events=PART).select("key", "part", "state"),
             "array_join(items, ',') AS state"),
    "map": (FO.ENTRIES, PART, lambda e: A.final_map(e, part_events=PART).select("key", "part", "state"),
            "to_json(map_from_arrays(seqs, payloads)) AS state"),
    "nested": (FO.nested_latest(TAG), None, lambda e: A.final_nested_latest(e, TAG), None),
}


@pytest.mark.parametrize("case", CASES)
def test_states_as_folds(spark, tmp_path, events, case):
    """A4-A9."""
    fold, parts, batch, state = CASES[case]
    part = FO.part_of("sequence_number", parts) if parts else None
    changes, ck = _resumed(spark, tmp_path, events, lambda s: FO.fold_stream(s, fold, ["sequence_number"], part))
    got = FO.latest(changes)
    assert got.agg(F.sum("version")).first()[0] == events.count()
    if case == "nested":
        got = got.select("key", "event_time", F.array_join("string_list", ",").alias("string_list"), "str_payload",
                         F.col("inner_payload.sequence_number").alias("inner_sequence_number"))
    else:
        got = got.selectExpr("key", *(["part"] if parts else []), state)
    assert _rows(got) == _rows(batch(events))
    if case == "list":  # the state store holds what the sink was told
        assert _rows(FO.states_of(spark, ck)) == _rows(FO.latest(changes))


def test_user_fold_with_nested_state_moves_into_a_changed_query(spark, tmp_path, events):
    """Job upgrade: a query is stopped; another one, with another output and checkpoint,
    starts from its states and reads the rest of the input."""
    def tally(event, old):
        counts, last = old or ({}, (0, ""))
        return {**counts, event.payload: counts.get(event.payload, 0) + 1}, (int(event.sequence_number), event.payload)

    def tally_twice(event, old):  # the changed job: counts by two from now on
        counts, last = old or ({}, (0, ""))
        return {**counts, event.payload: counts.get(event.payload, 0) + 2}, (int(event.sequence_number), event.payload)

    state = "counts map<string,bigint>, last struct<seq:bigint,payload:string>"
    ST.use_rocksdb(spark)
    n = write_slices(events, "event_time", str(tmp_path / "a"), "10 days", 0, 2)
    write_slices(events, "event_time", str(tmp_path / "b"), "10 days", n, None)
    run_to_parquet(FO.fold_stream(_stream(spark, events.schema, str(tmp_path / "a")), FO.Fold(state, tally), ["sequence_number"]),
                   str(tmp_path / "out-a"), str(tmp_path / "ck-a"))
    held = FO.states_of(spark, str(tmp_path / "ck-a"))
    first = _rows(held)
    run_to_parquet(FO.fold_stream(_stream(spark, events.schema, str(tmp_path / "b")), FO.Fold(state, tally_twice),
                                  ["sequence_number"], initial=held), str(tmp_path / "out-b"), str(tmp_path / "ck-b"))
    assert _rows(FO.states_of(spark, str(tmp_path / "ck-a"))) == first  # the old query's state is untouched
    got = {r["key"]: (r["counts"], tuple(r["last"]), r["version"]) for r in FO.states_of(spark, str(tmp_path / "ck-b")).collect()}
    early = {r[0] for r in spark.read.parquet(str(tmp_path / "a/slice-*")).select("event_id").collect()}
    want = {}
    for r in sorted(events.collect(), key=lambda r: (r["key"], r["sequence_number"])):
        counts, _, v = want.get(r["key"], ({}, None, 0))
        counts[r["payload"]] = counts.get(r["payload"], 0) + (1 if r["event_id"] in early else 2)
        want[r["key"]] = (counts, (r["sequence_number"], r["payload"]), v + 1)
    assert got == want
