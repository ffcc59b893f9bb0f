"""Stateful processors for the streaming forms that built-in operators cannot express:
emit-once joins (J2, J3), sequence checks (C1, C2), keyed state (A4-A8). Windows are in
``windows``, user folds in ``folds``.

They run with ``groupBy(key).transformWithStateInPandas``: Spark shuffles rows by key
and keeps the state in the state store (RocksDB); Python only sees one key's rows of one
micro-batch at a time. A micro-batch has no arrival order, so each call sorts its rows
by the explicit arrival columns first (the replay keeps batches in time order).
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import STATE_STORES
from . import windows

JOIN_OUT = "name string, city string, state string, auction_id long"
STATE_OUT = ("key long, sequence_number long, first_payload string, last_payload string, "
             "position long, map_entry string")


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORES["rocks"])


class EmitOnceJoin(StatefulProcessor):
    """J2 / J3 over a tagged union (side 0 = person, 1 = auction) keyed by person id.

    ``keep="last"``: a new person replaces the stored one (J2); ``keep="first"``: the
    stored person is never replaced (J3). Auctions arriving before any person wait in a
    list (repeats kept) or, with ``dedupe_waiting``, a map used as a set."""

    def __init__(self, keep: str = "last", dedupe_waiting: bool = False):
        self.keep, self.dedupe = keep, dedupe_waiting

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.person = handle.getValueState("person", "name string, city string, state string")
        if self.dedupe:
            self.waiting = handle.getMapState("waiting", "rid long", "seen boolean")
        else:
            self.waiting = handle.getListState("waiting", "rid long")

    def _waiting_ids(self):
        if not self.waiting.exists():
            return []
        if self.dedupe:
            return [k[0] for k in self.waiting.keys()]
        return [r[0] for r in self.waiting.get()]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        person = self.person.get() if self.person.exists() else None
        for pdf in rows:
            person, out = self._batch(pdf.sort_values(["date_time", "side", "rid", "copy"]), person)
            yield pd.DataFrame(out, columns=["name", "city", "state", "auction_id"])

    def _batch(self, pdf: pd.DataFrame, person) -> tuple:
        out = []
        for r in pdf.itertuples(index=False):
            if r.side == 0:
                if person is not None and self.keep == "first":
                    continue
                person = (r.name, r.city, r.state)
                self.person.update(person)
                for rid in self._waiting_ids():
                    out.append((*person, rid))
                self.waiting.clear()
            elif person is not None:
                out.append((*person, int(r.rid)))
            elif self.dedupe:
                self.waiting.updateValue((int(r.rid),), (True,))
            else:
                self.waiting.appendValue((int(r.rid),))
        return person, out

    def close(self) -> None:
        pass


def emit_once_stream(tagged: DataFrame, keep: str = "last", dedupe_waiting: bool = False) -> DataFrame:
    """``tagged``: k, date_time, side, rid, copy, name, city, state (streaming)."""
    return tagged.groupBy("k").transformWithStateInPandas(
        EmitOnceJoin(keep, dedupe_waiting), JOIN_OUT, "append", "None")


class SequenceCheck(StatefulProcessor):
    """C1 / C2 on a stream: the last sequence number of a key is kept for ever; an event
    whose number doesn't follow it gives an alert (``exactly_once``: by exactly 1,
    ``at_least_once``: by at most 1). The first event is held against 0."""

    def __init__(self, mode: str):
        if mode not in ("exactly_once", "at_least_once"):
            raise ValueError(f"unknown mode {mode!r}")
        self.exact = mode == "exactly_once"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq long")

    def handleInputRows(self, key, rows, timerValues):
        previous = int(self.last.get()[0]) if self.last.exists() else 0
        for pdf in rows:
            seq = pdf.sort_values(["event_time", "event_id", "copy"])["sequence_number"].astype("int64")
            before = seq.shift(1, fill_value=previous)
            bad = (seq - before != 1) if self.exact else (seq - before > 1)
            previous = int(seq.iloc[-1]) if len(seq) else previous
            yield pd.DataFrame({"key": int(key[0]), "previous": before[bad], "sequence_number": seq[bad]})
        self.last.update((previous,))

    def close(self) -> None:
        pass


def sequence_check_stream(ev: DataFrame, mode: str) -> DataFrame:
    """``ev``: key, event_time, event_id, copy, sequence_number (streaming), arriving in
    that order from batch to batch."""
    return ev.select("key", "event_time", "event_id", "copy", "sequence_number").groupBy("key").transformWithStateInPandas(
        SequenceCheck(mode), "key long, previous long, sequence_number long", "append", "None")


def early_session_stream(bids: DataFrame, gap_ms: int, every: int) -> DataFrame:
    """W6 on ``bids``: bidder, date_time (TIMESTAMP, watermarked), event_id (streaming).

    Sessions closed by ``gap_ms`` of inactivity; an early row each time ``every`` more bids
    arrived (running count), a final row when the watermark passes the session end. Bids may
    come in any order within the watermark's bound: a bid joins all sessions that it touches,
    and their counts and counters add up."""
    out = windows.keyed_windows_stream(bids, "bidder", "date_time", windows.Sessions(gap_ms), windows.EveryElements(every),
                                       windows.Count(), ["date_time", "event_id"])
    return out.select(F.col("key").alias("bidder"), F.col("window_start").alias("session_start"),
                      F.col("window_end").alias("session_end"), "num", "is_final")


class KeyedStates(StatefulProcessor):
    """A4-A8 on one key: first value, last value, growing list (its reverse is the
    concatenation, newest first) and map by sequence number.

    Emits, per event, what its state operations read back: the first and last value, the
    event's position in the list and the map's entry under its sequence number. The list
    and the map only grow by appends; no event rewrites or re-reads a history.

    ``ttl_ms`` (processing-time mode only) expires the last value after that long
    without an update (state time-to-live). Not yet verified: with an ``availableNow``
    trigger the processing-time query did not finish in our tests."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "payload string")
        self.last = (handle.getValueState("last", "payload string", self.ttl_ms) if self.ttl_ms
                     else handle.getValueState("last", "payload string"))
        self.size = handle.getValueState("size", "n long")
        self.items = handle.getListState("items", "payload string")
        self.map = handle.getMapState("by_seq", "seq long", "payload string")

    def handleInputRows(self, key, rows, timerValues):
        k = int(key[0])
        first = self.first.get()[0] if self.first.exists() else None
        n = int(self.size.get()[0]) if self.size.exists() else 0
        for pdf in rows:
            pdf = pdf.sort_values("sequence_number")
            out = []
            for seq, payload in zip(pdf["sequence_number"], pdf["payload"]):
                if first is None:                      # A4: store only when empty
                    first = payload
                    self.first.update((payload,))
                self.last.update((payload,))           # A5: overwrite
                self.map.updateValue((int(seq),), (payload,))  # A8
                n += 1
                out.append((k, int(seq), first, self.last.get()[0], n, self.map.getValue((int(seq),))[0]))
            self.items.appendList([(p,) for p in pdf["payload"]])  # A6, A7
            yield pd.DataFrame(out, columns=["key", "sequence_number", "first_payload", "last_payload", "position",
                                             "map_entry"])
        self.size.update((n,))

    def close(self) -> None:
        pass


def keyed_state_stream(ev: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """``ev``: key, sequence_number, payload (streaming)."""
    return ev.select("key", "sequence_number", "payload").groupBy("key").transformWithStateInPandas(
        KeyedStates(ttl_ms), STATE_OUT, "append", "ProcessingTime" if ttl_ms else "None")


def read_state(spark, checkpoint: str, state_var: str | None = None, operator_id: int = 0) -> DataFrame:
    """Queryable state: read a finished query's state store as a table (batch)."""
    r = spark.read.format("statestore").option("operatorId", operator_id)
    if state_var:
        r = r.option("stateVarName", state_var)
    return r.load(checkpoint)


def final_from_changes(changes: DataFrame) -> DataFrame:
    """The last emitted summary per key (batch)."""
    return changes.groupBy("key").agg(F.max_by(F.struct(*[c for c in changes.columns if c != "key"]),
                                               "sequence_number").alias("s")).select("key", "s.*")
