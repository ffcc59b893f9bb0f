"""Windows W1-W7 (tumbling, sliding, session) and the pane rewrite of sliding counts.

A row whose event time is null lies in no window and leaves every operator here, as it
does in the streaming forms; ``timeless_rows`` counts them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col_of, flat_window, to_ntz
from ..plans.keyed import keyed_running


def _ms(duration_ms: int) -> str:
    return f"{int(duration_ms)} milliseconds"


def _ms_interval(ms: Column) -> Column:
    """Day-time interval of ``ms`` milliseconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms.cast("decimal(18,6)") / F.lit(1000)).cast("decimal(18,6)"))


def timeless_rows(df: DataFrame, ts: str) -> DataFrame:
    """How many rows have no event time and so lie in no window: one row, ``dropped``."""
    return df.agg(F.count(F.when(F.col(ts).isNull(), 1)).alias("dropped"))


def tumbling_pass(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Every element re-emitted with the tumbling window that holds it.

    In batch the window is known per row, so no grouping is needed; a stream that must emit
    only when the window closes uses ``streaming.windows.window_members_stream``."""
    return df.select("*", F.window(ts, size).alias("_w")).select(
        *[F.col(c) for c in df.columns], *flat_window("_w"))


def tumbling_count(df: DataFrame, key: str, ts: str, size: str) -> DataFrame:
    """W2 with a computed size: count per key and tumbling window."""
    return (df.groupBy(F.window(ts, size).alias("_w"), key)
              .agg(F.count(F.lit(1)).alias("num"))
              .select(key, *flat_window("_w"), "num"))


def sliding_count(df: DataFrame, key: str, ts: str, size: str, slide: str) -> DataFrame:
    """W3 direct: Spark expands every row into size/slide windows before aggregating."""
    return (df.groupBy(F.window(ts, size, slide).alias("_w"), key)
              .agg(F.count(F.lit(1)).alias("num"))
              .select(key, *flat_window("_w"), "num"))


def sliding_count_panes(df: DataFrame, key: str, ts: str, size_ms: int, slide_ms: int) -> DataFrame:
    """W3 by panes: count per (key, slide-long pane) first, then spread each pane count
    over the size/slide windows that contain it and add.

    Exact when the slide divides the size. The raw rows are aggregated (map-side
    combined) before any expansion, so the expand and the second shuffle work on
    one row per (key, pane) instead of one per record."""
    if size_ms % slide_ms:
        raise ValueError("pane rewrite needs slide to divide size")
    n = size_ms // slide_ms
    slide_us, size_us = slide_ms * 1000, size_ms * 1000
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    # integer microseconds throughout: the pane start is us - pmod(us, slide)
    panes = (df.select(key, (us - F.pmod(us, F.lit(slide_us))).alias("_pane"))
               .groupBy(key, "_pane").agg(F.count(F.lit(1)).alias("_c")))
    spread = (panes.select(key, "_c", "_pane", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i"))
                   .select(key, "_c", (F.col("_pane") - F.col("_i").cast("bigint") * F.lit(slide_us).cast("bigint")).alias("_ws")))
    out = spread.groupBy(key, "_ws").agg(F.sum("_c").alias("num"))
    return out.select(key, to_ntz(F.timestamp_micros("_ws")).alias("window_start"),
                      to_ntz(F.timestamp_micros(F.col("_ws") + F.lit(size_us).cast("bigint"))).alias("window_end"),
                      F.col("num").cast("bigint").alias("num"))


def sliding_members(df: DataFrame, ts: str, size: str, slide: str) -> DataFrame:
    """W4 long form: one row per (element, sliding window holding it). No collection."""
    return df.select("*", F.window(ts, size, slide).alias("_w")).select(
        *[F.col(c) for c in df.columns], *flat_window("_w"))


# Events per part of a window's list: part of the operator's contract and a hard bound
# on every group.
LIST_PART_EVENTS = 1000


def sliding_collect(df: DataFrame, key: str, ts: str, size: str, slide: str,
                    seq: str, payload: str, part_events: int = LIST_PART_EVENTS) -> DataFrame:
    """Per key and sliding window, the window's events ordered by sequence.

    The list is cut by position inside the window into parts of ``part_events`` events (a
    window's list is its parts in ``part`` order), so a hot key's window never becomes one
    unbounded group; each part is returned as text (``seq:payload`` joined by commas)."""
    m = sliding_members(df.select(key, ts, seq, payload), ts, size, slide)
    m = keyed_running(m, [key, "window_start", "window_end"], [seq], {"_at": ("count", None)})
    m = m.withColumn("part", F.floor((F.col("_at") - 1) / F.lit(part_events)).cast("bigint"))
    g = m.groupBy(key, "window_start", "window_end", "part").agg(
        F.sort_array(F.collect_list(F.struct(F.col(seq), F.col(payload)))).alias("_l"))
    return g.select(key, "window_start", "window_end", "part",
                    F.size("_l").cast("bigint").alias("num"),
                    F.array_join(F.transform("_l", lambda x: F.concat_ws(":", x[seq].cast("string"), x[payload])), ",")
                    .alias("events"))


def session_count(df: DataFrame, key: str, ts: str, gap: str,
                  last_of: str | None = None, order: list[str] | None = None,
                  scan: bool = False) -> DataFrame:
    """Sessions per key closed by ``gap`` of inactivity; count per session.

    ``last_of`` adds ``last_<col>`` = value of the session's last row in ``order``.

    Batch (``scan``): sessions come from the skew-safe lag scan (``sessionize``) and the
    per-session aggregate is combined map-side, so a hot key is never held by one task.
    Without it ``session_window`` is used (the streaming form; in batch it shuffles every
    row by the key alone). Rows without a time belong to no session."""
    order = order or [ts]
    o = F.struct(*[F.col(c) for c in order])
    aggs = [F.count(F.lit(1)).alias("num")]
    if last_of:
        aggs.append(F.max_by(last_of, o).alias(f"last_{last_of}"))
    if not scan:
        g = df.groupBy(F.session_window(ts, gap).alias("_s"), key).agg(*aggs)
        return g.select(key, *flat_window("_s", "session"), *[c for c in g.columns if c not in ("_s", key)])
    s = sessionize(df, key, ts, gap, order)
    g = s.groupBy(key, "session_start").agg(F.max(ts).alias("_last"), *aggs)
    return g.select(key, to_ntz("session_start").alias("session_start"),
                    to_ntz(F.col("_last") + _interval(gap)).alias("session_end"),
                    F.col("num").cast("bigint").alias("num"),
                    *[c for c in g.columns if c.startswith("last_")])


def _interval(gap: str) -> Column:
    return F.expr(f"INTERVAL {gap}")


def sessionize(df: DataFrame, key: str, ts: str, gap: str, order: list[str]) -> DataFrame:
    """Batch sessions by lag: a new session starts when ts - previous ts > gap.

    Adds ``session_start`` and ``session_rn`` (position within the session, from 1). Both
    scans share one exchange by key; a key too large for a task is split."""
    df = df.filter(F.col(ts).isNotNull())
    r1 = keyed_running(df, [key], order, {"_prev_ts": ("prev", F.col(ts)), "_cnt": ("count", None)})
    r1 = r1.withColumn("_start", F.col("_prev_ts").isNull() | (F.col(ts) > F.col("_prev_ts") + _interval(gap)))
    r2 = keyed_running(r1, [key], order, {
        "session_start": ("last", F.when(F.col("_start"), F.col(ts))),
        "_cnt_at_start": ("last", F.when(F.col("_start"), F.col("_cnt"))),
    })
    return (r2.withColumn("session_rn", (F.col("_cnt") - F.col("_cnt_at_start") + 1).cast("bigint"))
              .drop("_prev_ts", "_cnt", "_start", "_cnt_at_start"))


def session_early(df: DataFrame, key: str, ts: str, gap: str, every: int, order: list[str]) -> DataFrame:
    """Session counts with early results.

    An early row fires each time ``every`` more elements reached the session (the counter
    is cleared, the contents kept, so the row carries the running count); the final row
    fires when the session ends. For in-order input the early rows are the elements whose
    position in the session is a multiple of ``every``; the session end at that moment is
    the element's time + gap."""
    s = sessionize(df, key, ts, gap, order)
    g = _interval(gap)
    early = (s.filter(F.col("session_rn") % every == 0)
              .select(key, to_ntz("session_start").alias("session_start"),
                      to_ntz(F.col(ts) + g).alias("session_end"),
                      F.col("session_rn").alias("num"), F.lit(False).alias("is_final")))
    final = (s.groupBy(key, "session_start")
              .agg(F.max(ts).alias("_last"), F.count(F.lit(1)).alias("num"))
              .select(key, to_ntz("session_start").alias("session_start"),
                      to_ntz(F.col("_last") + g).alias("session_end"),
                      F.col("num").cast("bigint").alias("num"), F.lit(True).alias("is_final")))
    return early.unionByName(final)
