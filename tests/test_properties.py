"""Cross-operator properties from the test strategy: join variants agree on unique
inputs, sliding windows hold each event factor times, sessions partition the input,
the last list element is the last value, panes equal the direct sliding count."""

from pyspark.sql import functions as F

from conftest import SF001, SF01
from eddy.operators import aggregates as A
from eddy.operators import joins as J
from eddy.operators import windows as W
from eddy.plans import queries as Q
from eddy.sources import bindings as B


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_join_variants_agree_on_unique_inputs(spark):
    a, p = B.auctions_q3(spark, SF001), B.persons_q3(spark, SF001)
    j1 = _set(J.incremental_join(a, p))
    j2 = _set(J.emit_once_last(a, p))
    j2s = _set(J.emit_once_last(a, p, dedupe_waiting=True))
    j3 = _set(J.emit_once_first(a, p))
    assert j1 == j2 == j2s == j3 and len(j1) > 0


def test_duplicates_separate_join_variants(spark):
    assert Q.q3_emit_once_last(spark, SF01).count() != Q.q3_emit_once_last_set(spark, SF01).count()
    assert _set(Q.q3_emit_once_last(spark, SF01)) != _set(Q.q3_emit_once_first(spark, SF01))


def test_every_event_in_factor_windows(spark):
    ev = B.keyed_events(spark, SF001)
    m = W.sliding_members(ev.select("key", "event_time", "sequence_number"), "event_time", Q.SIZE, Q.SLIDE)
    per_event = m.groupBy("key", "sequence_number").count()
    assert per_event.filter(F.col("count") != Q.SLIDE_FACTOR).count() == 0
    assert per_event.count() == ev.count()


def test_clean_events_raise_no_alert(spark):
    from eddy.operators import checks as C
    ev = B.keyed_events(spark, SF001)
    m = W.sliding_members(ev.select("key", "event_time", "sequence_number"), "event_time", Q.SIZE, Q.SLIDE)
    assert C.sequence_check(ev, "exactly_once", Q.EV_ORDER).count() == 0
    assert C.window_contiguity(m).count() == 0
    assert C.missed_window(m, Q.SLIDE_FACTOR).count() == 0
    assert C.seen_too_often(m, Q.SLIDE_FACTOR).count() == 0
    assert C.sequence_went_back(m).count() == 0


def test_sessions_partition_input(spark):
    bids = B.bids(spark, SF001)
    s = W.session_count(bids, "bidder", "date_time", Q.Q11_GAP, order=["date_time", "event_id"],
                        scan=True)
    assert s.agg(F.sum("num")).first()[0] == bids.count()
    # session_window (streaming form) gives the same sessions
    sw = W.session_count(bids, "bidder", "date_time", Q.Q11_GAP, order=["date_time", "event_id"])
    assert _set(s) == _set(sw)


def test_last_value_is_last_list_element(spark):
    ev = B.keyed_events(spark, SF001)
    last = {r.key: r.payload for r in A.final_last(ev).collect()}
    parts = A.final_list(ev).collect()
    tail = {}
    for r in sorted(parts, key=lambda r: (r.key, r.part)):
        tail[r.key] = r.state.split(",")[-1]
    assert tail == last


def test_panes_equal_direct(spark):
    assert _set(Q.q5_panes(spark, SF001)) == _set(Q.q5_sliding_count(spark, SF001))


def test_state_parts_reassemble(spark):
    """Growing states cut into small parts give back the whole state."""
    ev = B.keyed_events(spark, SF001)
    full = {}
    for r in ev.select("key", "sequence_number", "payload").collect():
        full.setdefault(r.key, []).append((r.sequence_number, r.payload))
    parts = A.final_list(ev, part_events=5).collect()
    assert max(r.part for r in parts) > 0
    got = {}
    for r in sorted(parts, key=lambda r: (r.key, r.part)):
        assert r.last_seq - r.first_seq < 5
        got.setdefault(r.key, []).extend(r.state.split(","))
    assert got == {k: [p for _, p in sorted(v)] for k, v in full.items()}
    cat = {}
    for r in sorted(A.final_concat(ev, part_events=5).collect(), key=lambda r: (r.key, -r.part)):
        cat[r.key] = cat.get(r.key, "") + r.state
    assert cat == {k: "".join(p for _, p in sorted(v, reverse=True)) for k, v in full.items()}
