"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the supplied tables (or data Spark derives from them) in full.
Column names and types match the DuckDB oracle in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Params
from ..operators import aggregates as A
from ..operators import checks as C
from ..operators import graph as G
from ..operators import joins as J
from ..operators import text as X
from ..operators import user_aggregates as UA
from ..operators import windows as W
from ..operators.records import AVRO_STATE_OPERATOR, KRYO_STATE_OPERATOR, complex_payload, flatten_payload
from ..operators.timing import late_rows
from ..schemas import AUCTION_MSG
from ..scratch import Scratch
from ..sources import bindings as B
from ..sources import fixtures as FX
from ..sources import messages as M
from ..sources.tables import read_table
from . import sql as SQL
from . import tpch as TPCH

# Query parameters (fixed so Spark and the oracle agree).
Q5_SIZE, Q5_SLIDE = "60 minutes", "1 minute"
Q5_SIZE_MS, Q5_SLIDE_MS = 3_600_000, 60_000
Q8_SIZE = "1 hour"
Q11_GAP = "6 hours"
Q11_EARLY_EVERY = 3
TUMBLE = "1 hour"
# W2 on the event table: 20 events x 3 minutes of clock progress = one hour.
# Events per part of the growing states and window lists: small enough to cut the test data.
STATE_PART, LIST_PART = 16, 2
EVENT_PARAMS = Params(clock_progress_ms=180_000)
SLIDE_MS, SLIDE_FACTOR = 3_600_000, 3
SLIDE, SIZE = "1 hour", "3 hours"
EV_ORDER = ["event_time", "event_id"]
# Arrival disorder of the late-data report, event_id + (event_id * 104729) % 20.
DISORDER_MULT, DISORDER_SPAN = 104729, 20
ARRIVAL = ["event_time", "event_id", "copy"]


def _ms(v: int) -> str:
    return f"{v} milliseconds"


# -- auction queries -------------------------------------------------------------------

def q3_join(spark, d):
    return J.incremental_join(B.auctions_q3(spark, d), B.persons_q3(spark, d))


def q3_emit_once_first(spark, d):
    return J.emit_once_first(FX.repeated_auctions(B.auctions_q3(spark, d)), FX.moved_persons(B.persons_q3(spark, d)))


def q3_emit_once_last(spark, d):
    return J.emit_once_last(FX.repeated_auctions(B.auctions_q3(spark, d)), FX.moved_persons(B.persons_q3(spark, d)))


def q3_emit_once_last_set(spark, d):
    return J.emit_once_last(FX.repeated_auctions(B.auctions_q3(spark, d)), FX.moved_persons(B.persons_q3(spark, d)),
                            dedupe_waiting=True)


def q5_sliding_count(spark, d):
    return W.sliding_count(B.bids(spark, d), "auction", "date_time", Q5_SIZE, Q5_SLIDE)


def q5_panes(spark, d):
    return W.sliding_count_panes(B.bids(spark, d), "auction", "date_time", Q5_SIZE_MS, Q5_SLIDE_MS)


def q8_window_join(spark, d):
    return J.window_join(B.persons_q8(spark, d), B.auctions_q8(spark, d), Q8_SIZE)


def q11_session_count(spark, d):
    return W.session_count(B.bids(spark, d), "bidder", "date_time", Q11_GAP, last_of="auction",
                           order=["date_time", "event_id"], scan=True)


def q11_session_early(spark, d):
    return W.session_early(B.bids(spark, d), "bidder", "date_time", Q11_GAP, Q11_EARLY_EVERY,
                           ["date_time", "event_id"])


# -- word counts -----------------------------------------------------------------------

def _tokens(spark, d):
    return X.tokens(B.text_lines(spark, d))


def word_count(spark, d):
    return X.word_count(_tokens(spark, d))


def word_count_running(spark, d):
    r = X.word_count_running(_tokens(spark, d))
    return r.select("doc_id", F.col("line_no").cast("bigint"), F.col("pos").cast("bigint"), "word",
                    F.col("n").cast("bigint"))


# -- windows on keyed events -----------------------------------------------------------

def tumbling_pass(spark, d):
    return W.tumbling_pass(B.keyed_events(spark, d), "event_time", TUMBLE)


def tumbling_by_events(spark, d):
    return W.tumbling_count(B.plain_events(spark, d), "key", "event_time", _ms(EVENT_PARAMS.tumbling_size_ms))


def sliding_collect(spark, d):
    return W.sliding_collect(B.keyed_events(spark, d), "key", "event_time", SIZE, SLIDE, "sequence_number", "payload",
                             LIST_PART)


# -- keyed state -----------------------------------------------------------------------

def state_first(spark, d):
    return A.final_first(B.plain_events(spark, d), seq=F.struct("event_time", "event_id"))


def state_last(spark, d):
    return A.final_last(B.plain_events(spark, d), seq=F.struct("event_time", "event_id"))


def state_concat(spark, d):
    return A.final_concat(B.keyed_events(spark, d), part_events=STATE_PART)


def state_list(spark, d):
    return A.final_list(B.keyed_events(spark, d), part_events=STATE_PART)


def state_map(spark, d):
    return A.final_map(B.keyed_events(spark, d), part_events=STATE_PART)


def state_map_merge(spark, d):
    e = B.events(spark, d)
    return A.final_map_merge(e.select(F.col("user_id").alias("key"), F.col("event_type").alias("map_key"),
                                      F.col("value").alias("map_value"), "ts", "event_id"),
                             "key", "map_key", "map_value", ["ts", "event_id"])


def state_nested_latest(spark, d):
    return A.final_nested_latest(B.keyed_events(spark, d), KRYO_STATE_OPERATOR)


def state_first_changes(spark, d):
    return A.with_first(B.plain_events(spark, d), "key", EV_ORDER)


def state_last_changes(spark, d):
    return A.with_last(B.plain_events(spark, d), "key", EV_ORDER)


def state_nested_changes(spark, d):
    return A.with_nested_latest(B.keyed_events(spark, d), KRYO_STATE_OPERATOR, "key", EV_ORDER)


def state_append_log(spark, d):
    return A.append_log(B.plain_events(spark, d), "key", EV_ORDER)


def running_sum(spark, d):
    """A3: keyed reduce by +, every event emitting the new sum (cents of the event value)."""
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "value"])
    x = e.select(F.col("user_id").alias("key"), F.col("ts").alias("event_time"), "event_id",
                 F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return A.with_running_sum(x, "key", "cents", EV_ORDER)


# -- checks ----------------------------------------------------------------------------

def _disturbed(spark, d):
    return FX.repeated(FX.gapped(B.keyed_events(spark, d)))


def check_exactly_once(spark, d):
    return C.sequence_check(_disturbed(spark, d), "exactly_once", ARRIVAL)


def check_at_least_once(spark, d):
    return C.sequence_check(_disturbed(spark, d), "at_least_once", ARRIVAL)


def _members(ev):
    return W.sliding_members(ev.select("key", "event_time", "sequence_number"), "event_time", SIZE, SLIDE)


def check_window_contiguity(spark, d):
    return C.window_contiguity(_members(FX.gapped(B.keyed_events(spark, d))))


def check_missed_window(spark, d):
    return C.missed_window(FX.drop_window(_members(B.keyed_events(spark, d))), SLIDE_FACTOR)


def _extra(spark, d):
    return FX.extra_window(_members(B.keyed_events(spark, d)), SLIDE_MS, SLIDE_MS * SLIDE_FACTOR)


def check_seen_too_often(spark, d):
    return C.seen_too_often(_extra(spark, d), SLIDE_FACTOR)


def check_sequence_back(spark, d):
    return C.sequence_went_back(_extra(spark, d))


def check_state_tag(spark, d):
    ev = B.keyed_events(spark, d)
    tag = F.when(F.pmod("sequence_number", F.lit(FX.WRONG_TAG_EVERY)) == 0, F.lit(AVRO_STATE_OPERATOR)) \
           .otherwise(F.lit(KRYO_STATE_OPERATOR))
    states = ev.select("key", "event_id", "event_time", "sequence_number",
                       complex_payload(tag).alias("state")).select("key", "event_id", "event_time", "sequence_number",
                                                                  F.col("state.str_payload").alias("str_payload"))
    return C.state_tag_check(states, KRYO_STATE_OPERATOR, EV_ORDER)


def reconcile(spark, d):
    # the word count is evaluated once, both sides read it back
    wc = Scratch(spark, "reconcile").table(word_count(spark, d), "words")
    return C.reconcile(wc, FX.word_counts_changed(wc), ["word"], "n")


def late_rows_report(spark, d):
    e = read_table(spark, d, "events", ["event_id", "ts"])
    x = e.select("event_id", "ts",
                 (F.col("event_id") + F.pmod(F.col("event_id") * DISORDER_MULT, F.lit(DISORDER_SPAN))).alias("arrival"))
    return late_rows(x, "ts", ["arrival", "event_id"], 0).select("event_id", "ts", "arrival", "watermark")


# -- sources and sinks -----------------------------------------------------------------

def json_decode(spark, d):
    a = B.auctions_q3(spark, d)
    return M.decode(M.encode(a, "id", ["id", "seller"]), AUCTION_MSG)


def upsert_latest(spark, d):
    from ..streaming.sinks import latest_per_key
    a = B.auctions_q3(spark, d)
    return latest_per_key(a, ["seller"], ["date_time", "id"]).select("seller", "id", "reserve")


# -- user aggregates -------------------------------------------------------------------

def top_list(spark, d):
    """The five largest values of every event type, by a mergeable user aggregate."""
    lists = UA.aggregate_by(B.events(spark, d), ["event_type"], ["value", "event_id"], UA.TopList(5))
    return lists.select("event_type", F.posexplode(F.arrays_zip("vals", "ids"))).select(
        "event_type", (F.col("pos") + 1).cast("bigint").alias("place"), F.col("col.vals").alias("value"),
        F.col("col.ids").alias("event_id"))


# -- graph -----------------------------------------------------------------------------

def connected_components(spark, d):
    return G.connected_components(B.order_graph(spark, d))


def trade_components(spark, d):
    """Customers and suppliers linked by order lines: paths of many hops."""
    return G.connected_components(B.trade_graph(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q3_join": q3_join,
    "q3_emit_once_last": q3_emit_once_last,
    "q3_emit_once_last_set": q3_emit_once_last_set,
    "q3_emit_once_first": q3_emit_once_first,
    "q5_panes": q5_panes,
    "q8_window_join": q8_window_join,
    "q11_session_count": q11_session_count,
    "q11_session_early": q11_session_early,
    "word_count": word_count,
    "word_count_running": word_count_running,
    "tumbling_pass": tumbling_pass,
    "tumbling_by_events": tumbling_by_events,
    "sliding_collect": sliding_collect,
    "state_first": state_first,
    "state_last": state_last,
    "state_concat": state_concat,
    "state_list": state_list,
    "state_map": state_map,
    "state_map_merge": state_map_merge,
    "state_nested_latest": state_nested_latest,
    "check_exactly_once": check_exactly_once,
    "check_at_least_once": check_at_least_once,
    "check_window_contiguity": check_window_contiguity,
    "check_missed_window": check_missed_window,
    "check_seen_too_often": check_seen_too_often,
    "check_sequence_back": check_sequence_back,
    "check_state_tag": check_state_tag,
    "reconcile": reconcile,
    "late_rows": late_rows_report,
    "json_decode": json_decode,
    "upsert_latest": upsert_latest,
    "state_first_changes": state_first_changes,
    "state_last_changes": state_last_changes,
    "state_nested_changes": state_nested_changes,
    "state_append_log": state_append_log,
    "running_sum": running_sum,
    "top_list": top_list,
    "q11_session_count_sql": SQL.q11_session_count_sql,
    "q3_join_sql": SQL.q3_join_sql,
    "q5_sliding_count_sql": SQL.q5_sliding_count_sql,
    "q8_window_join_sql": SQL.q8_window_join_sql,
    "connected_components": connected_components,
    "trade_components": trade_components,
    **TPCH.QUERIES,
}
