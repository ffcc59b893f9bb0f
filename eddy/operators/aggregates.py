"""Keyed state A1-A10 as aggregates.

``final_*`` give the state each key holds after its last event. Scalar states (first,
last, nested latest) are ``min_by``/``max_by`` aggregates with map-side partial
aggregation, so a hot key costs one partial row per task. Growing states (concat, list,
map) are returned in *parts* of at most ``PART_EVENTS`` events, cut by sequence number:
the key's state is its parts in part order. No single row, group or task ever has to
hold a key's whole history, however hot the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running
from .records import complex_payload, flatten_payload

# Events per part of a growing state: part of the operators' contract (a key's state is
# its parts in order), and a hard bound on every group.
PART_EVENTS = 1000


def final_first(ev: DataFrame, key="key", seq="sequence_number", payload="payload") -> DataFrame:
    """A4: value stored by the first event (later events leave it)."""
    return ev.groupBy(key).agg(F.min_by(payload, seq).alias(payload))


def final_last(ev: DataFrame, key="key", seq="sequence_number", payload="payload") -> DataFrame:
    """A5: value of the last event (blind write and read-then-write agree)."""
    return ev.groupBy(key).agg(F.max_by(payload, seq).alias(payload))


def _parts(ev, key, seq, payload, part_events):
    return (ev.withColumn("part", F.floor((F.col(seq) - 1) / F.lit(part_events)).cast("bigint"))
              .groupBy(key, "part")
              .agg(F.sort_array(F.collect_list(F.struct(F.col(seq), F.col(payload)))).alias("_l"),
                   F.min(seq).alias("first_seq"), F.max(seq).alias("last_seq")))


def final_concat(ev: DataFrame, key="key", seq="sequence_number", payload="payload",
                 part_events: int = PART_EVENTS) -> DataFrame:
    """state = payload || previous state (newest first).

    The key's state is the concatenation of its parts, newest part first."""
    g = _parts(ev, key, seq, payload, part_events)
    return g.select(key, "part", "first_seq", "last_seq",
                    F.array_join(F.transform(F.reverse("_l"), lambda x: x[payload]), "").alias("state"))


def final_list(ev: DataFrame, key="key", seq="sequence_number", payload="payload",
               part_events: int = PART_EVENTS) -> DataFrame:
    """List state, payloads appended in order; parts joined by ','."""
    g = _parts(ev, key, seq, payload, part_events)
    return g.select(key, "part", "first_seq", "last_seq",
                    F.array_join(F.transform("_l", lambda x: x[payload]), ",").alias("state"))


def final_map(ev: DataFrame, key="key", seq="sequence_number", payload="payload",
              part_events: int = PART_EVENTS) -> DataFrame:
    """Map state sequence -> payload. Sequences are unique per key, so the parts are
    disjoint maps; returned as JSON objects."""
    g = _parts(ev, key, seq, payload, part_events)
    return g.select(key, "part", "first_seq", "last_seq",
                    F.to_json(F.map_from_entries("_l")).alias("state"))


def final_map_merge(df: DataFrame, key: str, map_key: str, map_value: str, order: list[str]) -> DataFrame:
    """A10: every event puts entries into a map state; a later put of the same map key wins.

    Equivalent to folding ``map_concat`` with last-win dedup over the events in order;
    expressed as one aggregate per (key, map key)."""
    return df.groupBy(key, map_key).agg(
        F.max_by(map_value, F.struct(*[F.col(c) for c in order])).alias("map_value"))


def final_nested_latest(ev: DataFrame, tag: str, key="key", seq="sequence_number") -> DataFrame:
    """State becomes the nested record of the newest event."""
    g = ev.groupBy(key).agg(F.max_by(complex_payload(tag), F.col(seq)).alias("state"))
    return g.select(key, *flatten_payload("state"))


def with_running_sum(df: DataFrame, key: str, value: str, order: list[str], name: str = "total") -> DataFrame:
    """A2/A3 with a value: running keyed sum (reduce by +)."""
    return keyed_running(df, [key], order, {name: ("sum", F.col(value))})


def with_first(df: DataFrame, key: str, order: list[str], payload: str = "payload") -> DataFrame:
    """A4 change log: every event passes on with the value its key's state holds after it."""
    return keyed_running(df, [key], order, {"state": ("first", F.col(payload))})


def with_last(df: DataFrame, key: str, order: list[str], payload: str = "payload") -> DataFrame:
    """A5 change log: every event passes on with the state before it (read) and after it
    (blind write)."""
    return keyed_running(df, [key], order, {"before": ("prev", F.col(payload)), "state": ("last", F.col(payload))})


def with_nested_latest(df: DataFrame, tag: str, key: str, order: list[str], seq: str = "sequence_number") -> DataFrame:
    """A9 change log: every event passes on with the nested record it replaces."""
    r = keyed_running(df, [key], order, {"_before": ("prev", complex_payload(tag))})
    return r.select(*df.columns, F.col("_before.str_payload").alias("before_tag"),
                    F.col(f"_before.inner_payload.{seq}").alias("before_sequence"))


def append_log(df: DataFrame, key: str, order: list[str], payload: str = "payload") -> DataFrame:
    """A6-A8 change log: the growing state as an append log. Each event passes on with its
    position in its key's state; the concatenation, list or map after an event is the log
    up to its position, so no row holds a history."""
    return keyed_running(df, [key], order, {"position": ("count", None)}).select(*df.columns, "position")
