"""Keyed windows on streams: closing windows with their elements (W1, W4), checks over
closed windows (C3-C6), and aggregating windows with a user's trigger (W6 and others).

Each is a ``transformWithStateInPandas`` processor keyed by the record key; event-time
timers close windows once the watermark reaches their end. Elements wait in the state in
chunks of a pane (one slide long) and a range of ``part_events`` sequence numbers, so the
order in which a micro-batch brings them doesn't matter and no call holds a whole window:
a closing window is read and emitted chunk by chunk.

Elements whose windows have all been closed (behind the watermark) are dropped by Spark
(``numRowsDroppedByWatermark``), as in its own windows. Times are microseconds since the
epoch inside the processors; a row without a time or a sequence number lies in no window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MEMBERS_OUT = ("key long, window_start timestamp, window_end timestamp, part long, sequence_number long, "
               "payload string")
ALERTS_OUT = "check string, key long, window_start timestamp, sequence_number long, other long"


def _us(times: pd.Series) -> np.ndarray:
    return times.astype("datetime64[us]").astype("int64").to_numpy()


def _time(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


class _Chunks:
    """Sorted sequence numbers (and payloads) under a window or pane, in chunks of
    ``part_events`` consecutive numbers. ``places`` maps the window to its chunks' numbers."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, part_events: int, payload: bool):
        self.size, self.payload = part_events, payload
        more = ", payloads array<string>" if payload else ""
        self.items = handle.getMapState(name, "at long, chunk long", f"seqs array<long>{more}")
        self.places = handle.getMapState(f"{name}_places", "at long", "stop long, chunks array<long>")

    def windows(self) -> list[tuple[int, int]]:
        """(at, stop) of all windows or panes that wait."""
        return sorted((int(k[0]), int(v[0])) for k, v in self.places.iterator()) if self.places.exists() else []

    def add(self, at: int, stop: int, seqs: np.ndarray, payloads: list | None) -> bool:
        """Put elements under ``at``; True if it is new."""
        known = self.places.getValue((at,)) if self.places.containsKey((at,)) else None
        chunks = set(known[1]) if known else set()
        number = seqs // self.size
        for c in np.unique(number):
            pick = np.flatnonzero(number == c)
            c = int(c)
            s, p = seqs[pick].tolist(), [payloads[i] for i in pick] if self.payload else None
            if c in chunks:
                old = self.items.getValue((at, c))
                s, p = [*old[0], *s], [*old[1], *p] if self.payload else None
            order = sorted(range(len(s)), key=s.__getitem__)
            value = ([s[i] for i in order],)
            self.items.updateValue((at, c), (*value, [p[i] for i in order]) if self.payload else value)
            chunks.add(c)
        self.places.updateValue((at,), (stop, sorted(chunks)))
        return known is None

    def numbers(self, at: int) -> list[int]:
        return [int(c) for c in self.places.getValue((at,))[1]] if self.places.containsKey((at,)) else []

    def get(self, at: int, chunk: int):
        """(seqs, payloads or None) of one chunk."""
        v = self.items.getValue((at, chunk))
        return list(v[0]), list(v[1]) if self.payload else None

    def drop(self, at: int) -> None:
        for c in self.numbers(at):
            self.items.removeKey((at, c))
        self.places.removeKey((at,))


class WindowMembers(StatefulProcessor):
    """W4 (and, with one slide as the size, W1): every element of a window, emitted when
    the window closes, ordered by pane and sequence number, with the window's running part
    of ``part_events`` elements. An element waits once, however many windows hold it."""

    def __init__(self, size_ms: int, slide_ms: int, part_events: int):
        if size_ms % slide_ms:
            raise ValueError("the slide has to divide the size")
        self.size, self.slide, self.part = size_ms * 1000, slide_ms * 1000, part_events

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = _Chunks(handle, "panes", self.part, payload=True)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            pdf = pdf.dropna(subset=["event_time", "sequence_number"])
            at = _us(pdf["event_time"])
            pane = at - at % self.slide
            seqs, payloads = pdf["sequence_number"].to_numpy(dtype="int64"), pdf["payload"].tolist()
            for p in np.unique(pane):
                pick = np.flatnonzero(pane == p)
                p = int(p)
                if self.panes.add(p, p + self.size, seqs[pick], [payloads[i] for i in pick]):
                    for end in range(p + self.slide, p + self.size + 1, self.slide):
                        self.handle.registerTimer(end // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        start, at = end - self.size, 0
        for pane in range(start, end, self.slide):
            for c in self.panes.numbers(pane):
                seqs, payloads = self.panes.get(pane, c)
                part = (at + np.arange(len(seqs))) // self.part
                at += len(seqs)
                yield pd.DataFrame({"key": int(key[0]), "window_start": _time(start), "window_end": _time(end),
                                    "part": part, "sequence_number": seqs, "payload": payloads})
        if self.panes.places.containsKey((start,)):  # its last window
            self.panes.drop(start)

    def close(self) -> None:
        pass


def window_members_stream(ev: DataFrame, size_ms: int, slide_ms: int, part_events: int = 1000) -> DataFrame:
    """``ev``: key, event_time (watermarked), sequence_number, payload (streaming). Gives
    key, window_start, window_end, part, sequence_number, payload of every closed window."""
    return ev.select("key", "event_time", "sequence_number", "payload").groupBy("key").transformWithStateInPandas(
        WindowMembers(size_ms, slide_ms, part_events), MEMBERS_OUT, "append", "EventTime")


def collected(members: DataFrame) -> DataFrame:
    """The lists of ``windows.sliding_collect`` from members written by the stream (batch)."""
    g = members.groupBy("key", "window_start", "window_end", "part").agg(
        F.sort_array(F.collect_list(F.struct("sequence_number", "payload"))).alias("_l"))
    text = F.transform("_l", lambda x: F.concat_ws(":", x["sequence_number"].cast("string"), x["payload"]))
    return g.select("key", F.col("window_start").cast("timestamp_ntz"), F.col("window_end").cast("timestamp_ntz"), "part",
                    F.size("_l").cast("bigint").alias("num"), F.array_join(text, ",").alias("events"))


class WindowChecks(StatefulProcessor):
    """C3-C6 on the members of closed windows. A key's windows are checked in the order of
    their ends; between them the key keeps the largest sequence number seen and the events
    pending: seen in every window since their first one, less than ``factor`` times yet.

    Alerts: contiguity (C3: ``other`` is the previous number), missed_window (C4: how often
    it was seen; ``window_start`` is the window that missed it), seen_too_often (C5),
    sequence_back (C6: ``sequence_number`` is the window's last, ``other`` the largest seen).
    A sequence number that a window holds twice counts once, and is a C3 alert."""

    def __init__(self, factor: int, part_events: int):
        self.factor, self.part = factor, part_events

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = _Chunks(handle, "open", self.part, payload=False)
        self.largest = handle.getValueState("largest", "seq long")
        self.pending = handle.getMapState("pending", "chunk long", "seqs array<long>, seen array<long>")
        self.waiting = handle.getValueState("waiting", "chunks array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            pdf = pdf.dropna(subset=["window_start", "window_end", "sequence_number"])
            start, end = _us(pdf["window_start"]), _us(pdf["window_end"])
            seqs = pdf["sequence_number"].to_numpy(dtype="int64")
            for w in np.unique(start):
                pick = np.flatnonzero(start == w)
                stop = int(end[pick].max())
                if self.open.add(int(w), stop, seqs[pick], None):
                    self.handle.registerTimer(stop // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        for at, stop in self.open.windows():
            if stop <= now:
                yield from self._check(int(key[0]), at)
                self.open.drop(at)

    def _check(self, key: int, window: int) -> Iterator[pd.DataFrame]:
        before = int(self.largest.get()[0]) if self.largest.exists() else None
        old = {int(c) for c in self.waiting.get()[0]} if self.waiting.exists() else set()
        held, keep = set(self.open.numbers(window)), []
        previous = last = None
        for c in sorted(old | held):
            alerts = []
            pending = dict(zip(*map(list, self.pending.getValue((c,))))) if c in old else {}
            seqs = self.open.get(window, c)[0] if c in held else []
            for s in seqs:
                if previous is not None and s - previous != 1:
                    alerts.append(("contiguity", s, previous))
                previous = last = s
            seen = set(seqs)
            alerts += [("missed_window", s, n) for s, n in pending.items() if s not in seen]
            left = {}
            for s in sorted(seen):
                if s not in pending and before is not None and s <= before:
                    alerts.append(("seen_too_often", s, None))
                elif pending.get(s, 0) + 1 < self.factor:
                    left[s] = pending.get(s, 0) + 1
            if left:
                self.pending.updateValue((c,), (list(left), list(left.values())))
                keep.append(c)
            elif c in old:
                self.pending.removeKey((c,))
            yield self._frame(key, window, alerts)
        self.waiting.update((keep,))
        if before is not None and last < before:
            yield self._frame(key, window, [("sequence_back", last, before)])
        self.largest.update((last if before is None else max(last, before),))

    @staticmethod
    def _frame(key: int, window: int, alerts: list) -> pd.DataFrame:
        out = pd.DataFrame(alerts, columns=["check", "sequence_number", "other"])
        return pd.DataFrame({"check": out["check"], "key": key, "window_start": _time(window),
                             "sequence_number": out["sequence_number"], "other": out["other"].astype("Int64")})

    def close(self) -> None:
        pass


def window_checks_stream(members: DataFrame, factor: int, part_events: int = 1000) -> DataFrame:
    """``members``: key, window_start, window_end (TIMESTAMP, ``window_end`` watermarked),
    sequence_number (streaming), such as ``window_members_stream`` writes."""
    return (members.select("key", "window_start", "window_end", "sequence_number").groupBy("key")
            .transformWithStateInPandas(WindowChecks(factor, part_events), ALERTS_OUT, "append", "EventTime"))


# Aggregating windows with a trigger ------------------------------------------------

CONTINUE, FIRE, FIRE_AND_PURGE = "continue", "fire", "fire_and_purge"


class Trigger:
    """When a window gives a result. ``counters`` are the trigger's own numbers per window
    (``fields`` names them); they add up where windows merge."""

    fields: tuple[str, ...] = ()

    def on_element(self, counters: list[int], row) -> str:
        """Called after ``row`` was added; may change ``counters``."""
        return CONTINUE

    def on_close(self, counters: list[int]) -> str:
        """Called when the watermark reaches the window's end."""
        return FIRE_AND_PURGE

    def merge(self, a: list[int], b: list[int]) -> list[int]:
        return [x + y for x, y in zip(a, b)]


class EveryElements(Trigger):
    """An early result each time ``every`` more elements came (contents kept, the counter
    cleared), the final one at the window's end. ``purge`` starts anew after each result."""

    fields = ("counter",)

    def __init__(self, every: int, purge: bool = False):
        self.every, self.action = every, FIRE_AND_PURGE if purge else FIRE

    def on_element(self, counters, row):
        counters[0] += 1
        if counters[0] < self.every:
            return CONTINUE
        counters[0] = 0
        return self.action


class Aggregate:
    """What a window keeps: ``state`` and ``result`` are schemas, the accumulator is a list
    of the state's fields."""

    state = "num long"
    result = "num long"

    def create(self) -> list:
        return [0]

    def add(self, acc: list, row) -> list:
        return [acc[0] + 1]

    def merge(self, a: list, b: list) -> list:
        return [a[0] + b[0]]

    def value(self, acc: list) -> tuple:
        return (acc[0],)


class Count(Aggregate):
    """Number of elements."""


class Windows:
    """Which windows hold an element: [start, stop) pairs of microseconds."""

    merging = False

    def of(self, at: int) -> list[tuple[int, int]]:
        raise NotImplementedError


class Sliding(Windows):
    """Windows of ``size_ms`` every ``slide_ms`` (tumbling where both are equal)."""

    def __init__(self, size_ms: int, slide_ms: int | None = None):
        self.size, self.slide = size_ms * 1000, (slide_ms or size_ms) * 1000

    def of(self, at):
        last = at - at % self.slide
        return [(s, s + self.size) for s in range(last, at - self.size, -self.slide)]


class Sessions(Windows):
    """A window reaches ``gap_ms`` beyond its last element; windows that touch merge."""

    merging = True

    def __init__(self, gap_ms: int):
        self.gap = gap_ms * 1000

    def of(self, at):
        return [(at, at + self.gap)]


class KeyedWindows(StatefulProcessor):
    """Windows of one key: accumulator and trigger counters by window start, in map state.

    Rows of a call are taken in the order of ``order``. A merging window takes in every
    window that it touches (a gap exactly reached is the same session): accumulators and
    counters merge, the end only moves on."""

    def __init__(self, windows: Windows, trigger: Trigger, aggregate: Aggregate, time: str, order: list[str]):
        self.windows, self.trigger, self.aggregate, self.time, self.order = windows, trigger, aggregate, time, order
        self.names = [x.strip().split()[0] for x in aggregate.result.split(",")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        counters = "".join(f"trigger_{f} long, " for f in self.trigger.fields)
        self.kept = handle.getMapState("windows", "start long", f"stop long, {counters}{self.aggregate.state}")

    def _load(self) -> dict[int, list]:
        """start -> [stop, counters, accumulator]: the open windows of the key."""
        k = 1 + len(self.trigger.fields)
        if not self.kept.exists():
            return {}
        return {int(s[0]): [int(v[0]), [int(x) for x in v[1:k]], list(v[k:])] for s, v in self.kept.iterator()}

    def _store(self, before: dict[int, int], now: dict[int, list], touched: set[int]) -> None:
        for s in before.keys() - now.keys():
            self.kept.removeKey((s,))
        for s in touched & now.keys():
            self.kept.updateValue((s,), (now[s][0], *now[s][1], *now[s][2]))
        old, new = {x // 1000 for x in before.values()}, {w[0] // 1000 for w in now.values()}
        for t in old - new:
            self.handle.deleteTimer(t)
        for t in new - old:
            self.handle.registerTimer(t)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = self._load()
        before, touched, out = {s: w[0] for s, w in now.items()}, set(), []
        for pdf in rows:
            pdf = pdf.dropna(subset=[self.time]).sort_values(self.order)
            for at, row in zip(_us(pdf[self.time]).tolist(), pdf.itertuples(index=False)):
                for start, stop in self.windows.of(at):
                    if self.windows.merging:
                        met = [s for s, w in now.items() if s <= stop and start <= w[0]]
                        window = [stop, [0] * len(self.trigger.fields), self.aggregate.create()]
                        for s in met:
                            w = now.pop(s)
                            start, window[0] = min(start, s), max(window[0], w[0])
                            window[1] = self.trigger.merge(window[1], w[1])
                            window[2] = self.aggregate.merge(window[2], w[2])
                        now[start] = window
                    else:
                        window = now.setdefault(start, [stop, [0] * len(self.trigger.fields), self.aggregate.create()])
                    window[2] = self.aggregate.add(window[2], row)
                    action = self.trigger.on_element(window[1], row)
                    if action != CONTINUE:
                        out.append((key[0], _time(start), _time(window[0]), *self.aggregate.value(window[2]), False))
                    if action == FIRE_AND_PURGE:
                        window[2] = self.aggregate.create()
                    touched.add(start)
            if len(out) >= 1000:
                yield self._frame(out)
                out = []
        self._store(before, now, touched)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        time = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for start, (stop, counters, acc) in sorted(self._load().items()):
            if stop // 1000 <= time:
                if self.trigger.on_close(counters) != CONTINUE:
                    out.append((key[0], _time(start), _time(stop), *self.aggregate.value(acc), True))
                self.kept.removeKey((start,))
        yield self._frame(out)

    def _frame(self, out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["key", "window_start", "window_end", *self.names, "is_final"])

    def close(self) -> None:
        pass


def keyed_windows_stream(df: DataFrame, key: str, time: str, windows: Windows, trigger: Trigger, aggregate: Aggregate,
                         order: list[str]) -> DataFrame:
    """``df`` (streaming, ``time`` watermarked) -> key, window_start, window_end, the
    aggregate's result, is_final: one row for every time the trigger fires."""
    kind = df.schema[key].dataType.simpleString()
    out = f"key {kind}, window_start timestamp, window_end timestamp, {aggregate.result}, is_final boolean"
    return df.groupBy(key).transformWithStateInPandas(
        KeyedWindows(windows, trigger, aggregate, time, order), out, "append", "EventTime")
