"""Guarantee checks C1-C8: each returns one row per alert; no rows means the guarantee held.

All checks are joins, aggregates and window functions over bounded partitions:
per-key scans go through the skew-safe keyed scan; per-window work is partitioned by
(key, window); per-key window numbering runs on the small one-row-per-window table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ALERT
from ..plans.keyed import keyed_running


def sequence_check(ev: DataFrame, mode: str, order: list[str], key="key",
                   seq="sequence_number") -> DataFrame:
    """C1 (``exactly_once``: next - previous must be 1) and C2 (``at_least_once``: at
    most 1). The previous value starts at 0 and moves on after an alert."""
    r = keyed_running(ev, [key], order, {"_prev": ("prev", F.col(seq))})
    prev = F.coalesce(F.col("_prev"), F.lit(0)).cast("bigint")
    d = F.col(seq) - prev
    bad = d != 1 if mode == "exactly_once" else d > 1
    return r.filter(bad).select(
        key, prev.alias("previous"), F.col(seq).alias("sequence_number"),
        F.format_string(ALERT + "%d -> %d (%d)", prev, F.col(seq), F.col(key)).alias("alert"))


def window_contiguity(members: DataFrame, key="key", win="window_start", seq="sequence_number") -> DataFrame:
    """Inside each window, sorted by sequence, neighbours must differ by exactly 1. A
    window too large for a task is split by the keyed scan."""
    x = keyed_running(members.select(key, win, seq), [key, win], [seq], {"_p": ("prev", F.col(seq))})
    return x.filter(F.col("_p").isNotNull() & (F.col(seq) - F.col("_p") != 1)).select(
        key, win, F.col("_p").alias("previous"), F.col(seq).alias("sequence_number"))


def _window_table(members: DataFrame, key, win, seq) -> DataFrame:
    """One row per non-empty (key, window): rank among the key's windows, the window's
    last sequence, the largest last sequence of all earlier windows, the next window. A key with very
    many windows (short slides) is split by the keyed scan."""
    wins = members.groupBy(key, win).agg(F.max(seq).alias("wmax"))
    return keyed_running(wins, [key], [win], {
        "wrank": ("count", None), "mprev": ("max_before", F.col("wmax")), "wnext": ("next", F.col(win))})


def _sightings(members: DataFrame, factor: int, key, win, seq) -> tuple[DataFrame, DataFrame]:
    wins = _window_table(members, key, win, seq)
    x = members.select(key, win, seq).join(wins, [key, win])
    we = Window.partitionBy(key, seq).orderBy("wrank")
    wall = Window.partitionBy(key, seq)
    x = (x.withColumn("_rn", F.row_number().over(we))
          .withColumn("_r1", F.min("wrank").over(wall))
          .withColumn("_m1", F.first("mprev").over(we.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    x = (x.withColumn("_run", F.sum(F.when(F.col("wrank") - F.col("_rn") == F.col("_r1") - 1, 1).otherwise(0)).over(wall))
          .withColumn("_tracked", F.col("_m1").isNull() | (F.col(seq) > F.col("_m1"))))
    return x, wins


def missed_window(members: DataFrame, factor: int, key="key", win="window_start", seq="sequence_number") -> DataFrame:
    """C4: an event tracked since its first window is absent from the key's next
    non-empty window before it was seen ``factor`` times. Reports how often it was seen
    and the window that missed it."""
    x, _ = _sightings(members, factor, key, win, seq)
    # the last sighting of the first run; the key's next window is the one that missed it
    ev = x.filter((F.col("_rn") == F.col("_run")) & F.col("_tracked") & (F.col("_run") < factor) & F.col("wnext").isNotNull())
    return ev.select(key, F.col(seq).alias("sequence_number"), F.col("_run").cast("bigint").alias("seen"),
                     F.col("wnext").alias("missed_window"))


def seen_too_often(members: DataFrame, factor: int, key="key", win="window_start", seq="sequence_number") -> DataFrame:
    """A sighting of an event that is not being tracked and whose sequence is not
    above the last sequence seen: after its first run of ``factor`` consecutive windows,
    outside that run, or an event first seen at or below the key's last sequence."""
    x, _ = _sightings(members, factor, key, win, seq)
    bad = (~F.col("_tracked")) | (F.col("_rn") > F.least(F.col("_run"), F.lit(factor)))
    return x.filter(bad).select(key, F.col(seq).alias("sequence_number"), win)


def sequence_went_back(members: DataFrame, key="key", win="window_start", seq="sequence_number") -> DataFrame:
    """A window's last sequence is below the largest last sequence of earlier windows."""
    wins = _window_table(members, key, win, seq)
    return wins.filter(F.col("wmax") < F.col("mprev")).select(
        key, win, F.col("wmax").alias("last_sequence"), F.col("mprev").alias("seen_so_far"))


def state_tag_check(states: DataFrame, operator_name: str, order: list[str], key="key",
                    seq="sequence_number", tag="str_payload") -> DataFrame:
    """When the key's previous state belongs to the previous sequence number, its tag
    must be this operator's name (state restored into the wrong operator otherwise)."""
    r = keyed_running(states, [key], order,
                      {"_ptag": ("prev", F.col(tag)), "_pseq": ("prev", F.col(seq))})
    bad = F.col("_ptag").isNotNull() & (F.col("_ptag") != operator_name) & (F.col("_pseq") == F.col(seq) - 1)
    return r.filter(bad).select(key, F.col(seq).alias("sequence_number"),
                                F.lit(operator_name).alias("expected_tag"), F.col("_ptag").alias("actual_tag"))


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Compare expected and actual key -> value sets: ``missing`` (expected only),
    ``unexpected`` (actual only), ``wrong_value`` (both, different). Matches are dropped. A key that is
    present with a null value is present."""
    e = expected.select(*keys, F.col(value).alias("expected"), F.lit(True).alias("_e"))
    a = actual.select(*keys, F.col(value).alias("actual"), F.lit(True).alias("_a"))
    j = e.join(a, keys, "full_outer")
    status = (F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "unexpected")
               .when(~F.col("expected").eqNullSafe(F.col("actual")), "wrong_value"))
    return j.select(*keys, "expected", "actual", status.alias("status")).filter(F.col("status").isNotNull())
