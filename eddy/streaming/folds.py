"""User folds over keyed streams: (event, old state) -> new state.

A fold is a state schema (any nested type) and a function. The state of a key is kept in
parts: a column of the input says which part an event belongs to, so a state that grows
(a list, a map, a text) is cut into parts of bounded size and an event rewrites its part
only. A state that doesn't grow has one part, 0.

Every call emits one row for each part it changed: key, part, version (events folded into
the part so far) and the state. ``latest`` takes the last version of each part. A stopped
query's states (``states_of``) can be the initial state of a new query, so that a changed
job goes on where the old one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import Row, StructType, _parse_datatype_string

from .stateful import read_state


@dataclass(frozen=True)
class Fold:
    """``step(event, old)`` gives the state's fields as a tuple; ``old`` is None at first,
    else the tuple it gave last. ``event`` has the input's columns as attributes."""

    state: str
    step: Callable[[tuple, tuple | None], tuple]

    @property
    def fields(self) -> StructType:
        return _parse_datatype_string(self.state)


def _first(event, old):
    return old or (event.payload,)


def _last(event, old):
    return (event.payload,)


def _concat(event, old):
    return (event.payload + (old[0] if old else ""),)


def _items(event, old):
    return ([*(old[0] if old else ()), event.payload],)


def _entries(event, old):
    entries = dict(zip(*old)) if old else {}
    entries[int(event.sequence_number)] = event.payload
    return list(entries), list(entries.values())


@dataclass(frozen=True)
class _Nested:
    """The nested record of the newest event, with the operator's tag."""

    tag: str

    def __call__(self, event, old):
        return (event.event_time, [str(event.key), event.payload], self.tag, (int(event.sequence_number),))


FIRST, LAST = Fold("payload string", _first), Fold("payload string", _last)
CONCAT = Fold("state string", _concat)
ITEMS = Fold("items array<string>", _items)
#: A map state as keys and values: the state store's maps take string keys only.
ENTRIES = Fold("seqs array<bigint>, payloads array<string>", _entries)


def nested_latest(tag: str) -> Fold:
    return Fold("event_time timestamp, string_list array<string>, str_payload string, "
                "inner_payload struct<sequence_number:bigint>", _Nested(tag))


def _plain(value):
    """State values as tuples, lists and dicts."""
    if isinstance(value, Row):
        return tuple(_plain(x) for x in value)
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return [_plain(x) for x in value]
    return value


class FoldState(StatefulProcessor):
    def __init__(self, fold: Fold, order: list[str]):
        self.fold, self.order = fold, order
        self.names = fold.fields.names
        self.structs = {f.name: f.dataType.names for f in fold.fields.fields if isinstance(f.dataType, StructType)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.parts = handle.getMapState("parts", "part long", f"version long, {self.fold.state}")

    def _load(self, part: int) -> tuple[int, tuple | None]:
        if not self.parts.containsKey((part,)):
            return 0, None
        v = self.parts.getValue((part,))
        return int(v[0]), tuple(_plain(x) for x in v[1:])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for part, events in pdf.sort_values(self.order).groupby("part", sort=True):
                version, state = self._load(int(part))
                for event in events.itertuples(index=False):
                    state = tuple(self.fold.step(event, state))
                version += len(events)
                self.parts.updateValue((int(part),), (version, *state))
                yield self._frame(key[0], int(part), version, state)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            state = [_plain(getattr(row, n)) for n in self.names]
            state = [tuple(x[m] for m in self.structs[n]) if isinstance(x, dict) and n in self.structs else x
                     for n, x in zip(self.names, state)]
            self.parts.updateValue((int(row.part),), (int(row.version), *state))

    def _frame(self, key, part: int, version: int, state: tuple) -> pd.DataFrame:
        cells = {n: [dict(zip(self.structs[n], x)) if n in self.structs else x] for n, x in zip(self.names, state)}
        return pd.DataFrame({"key": [key], "part": [part], "version": [version], **cells})

    def close(self) -> None:
        pass


def fold_stream(events: DataFrame, fold: Fold, order: list[str], part: Column | None = None,
                initial: DataFrame | None = None) -> DataFrame:
    """``events``: key and what the fold reads (streaming). A call takes its rows in the
    order of ``order``; ``part`` is the part an event belongs to (default: one part).
    ``initial``: key, part, version and the state, of keys that a new query starts with."""
    kind = events.schema["key"].dataType.simpleString()
    keyed = events.withColumn("part", F.lit(0).cast("long") if part is None else part.cast("long")).groupBy("key")
    out = f"key {kind}, part long, version long, {fold.state}"
    return keyed.transformWithStateInPandas(
        FoldState(fold, order), out, "append", "None", initialState=None if initial is None else initial.groupBy("key"))


def part_of(seq: str, part_events: int) -> Column:
    """The part of a sequence number, as in the batch forms of growing states."""
    return F.floor((F.col(seq) - 1) / F.lit(part_events)).cast("bigint")


def latest(changes: DataFrame) -> DataFrame:
    """The last version of every part, from what a fold's sink holds (batch)."""
    state = [c for c in changes.columns if c not in ("key", "part")]
    g = changes.groupBy("key", "part").agg(F.max_by(F.struct(*state), "version").alias("s"))
    return g.select("key", "part", "s.*")


def states_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """key, part, version and the state that a stopped fold query holds (batch)."""
    r = read_state(spark, checkpoint, "parts")
    return r.select(F.col("key.key").alias("key"), F.col("user_map_key.part").alias("part"), "user_map_value.*")
