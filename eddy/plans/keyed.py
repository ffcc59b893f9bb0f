"""Skew-safe running computations per key.

Many operators need "the state of this key just after this record" in arrival order:
per-key sequence numbers, the previous value, a running sum or maximum, the latest
non-null value (as-of lookups). The textbook plan is one window partitioned by the key: a
single exchange, and the best plan as long as no key outgrows a task.

``keyed_running`` uses exactly that plan unless some key holds more than ``split_rows``
rows. When the whole input is known to be small (its size by the optimizer's statistics)
nothing is measured; otherwise one aggregate over the key columns finds the heavy keys.
Their rows, and only theirs, take the split plan:

1. they are written once to the shared folder, dealt to ranges of (key, order) that Spark
   samples, so each range holds about ``split_rows`` rows and ranges rise along the order;
2. inside every (key, range) a running window gives the local value;
3. a partial aggregate gives one total per (key, range) and a window over these few rows
   the combination of all earlier (or later) ranges of the key;
4. the offsets join back on (key, range).

The split changes the plan, never a result. Keys may be null (nulls are one key); rows
with null order columns come first. The order columns must make the order strict.

Supported kinds (all associative, so the split is exact):

``count``  running number of rows, current included (row_number)
``sum``    running sum, current included
``max`` / ``min``  running extreme, current included
``max_before``  largest value over the earlier rows only (null on the key's first row)
``last``   last non-null value at or before the current row
``prev``   the previous row's value (lag 1), null on the key's first row
``next``   the next row's value (lead 1), null on the key's last row
``first``  the key's first non-null value, on every row of the key
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

# Rows of one key that a single task may hold.
SPLIT_ROWS = 4_000_000
# An input of at most this size (optimizer's estimate) can't hold a heavy key.
SMALL_BYTES = 64 << 20
SPLIT_CONF = "spark.eddy.splitRows"
_PART = "_kr_part"

Specs = dict[str, tuple[str, Column | None]]


def keyed_running(df: DataFrame, keys: list[str], order: list[str], specs: Specs,
                  split_rows: int | None = None) -> DataFrame:
    """``df`` plus one column per spec. ``split_rows`` (or the session setting
    ``spark.eddy.splitRows``) is the number of rows of a key from which it is split."""
    wanted = split_rows or df.sparkSession.conf.get(SPLIT_CONF, None)
    if wanted is None and _estimated_bytes(df) <= SMALL_BYTES:
        return _plain(df, keys, order, specs)
    limit = int(wanted or SPLIT_ROWS)
    scratch = Scratch(df.sparkSession, "keyed")
    heavy = scratch.table(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kr_n")).where(F.col("_kr_n") > limit), "heavy")
    total = heavy.agg(F.sum("_kr_n")).first()[0]
    if total is None:
        scratch.drop(heavy)
        return _plain(df, keys, order, specs)
    heavy = heavy.select(*[F.col(k).alias(f"_kr_k_{k}") for k in keys])
    same = _all(F.col(k).eqNullSafe(F.col(f"_kr_k_{k}")) for k in keys)
    rows = df.join(heavy, same, "left_semi").repartitionByRange(-(-total // limit) + 1, *keys, *order)
    rows = scratch.table(rows.withColumn(_PART, F.spark_partition_id()), "rows")
    light = _plain(df.join(heavy, same, "left_anti"), keys, order, specs)
    return light.unionByName(_split(rows, df.columns, keys, order, specs))


def _estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def _windows(keys: list[str], order: list[str]):
    w = Window.partitionBy(*keys).orderBy(*order)
    return w, w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)


def _local(kind: str, e: Column | None, keys: list[str], order: list[str]) -> Column:
    """The value inside the rows of ``keys``. ``prev`` and ``next`` come wrapped in a
    struct, null only where there is no such row."""
    w, upto, before = _windows(keys, order)
    if kind == "count":
        return F.count(F.lit(1)).over(upto)
    if kind in ("sum", "max", "min"):
        return getattr(F, kind)(e).over(upto)
    if kind == "max_before":
        return F.max(e).over(before)
    if kind == "last":
        return F.last(e, ignorenulls=True).over(upto)
    if kind == "prev":
        return F.lag(F.struct(e.alias("v"))).over(w)
    if kind == "next":
        return F.lead(F.struct(e.alias("v"))).over(w)
    if kind == "first":
        return F.first(e, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    raise ValueError(f"unknown running kind {kind!r}")


def _kept(df: DataFrame | list[str], specs: Specs) -> list[str]:
    return [c for c in (df if isinstance(df, list) else df.columns) if c not in specs]


def _plain(df: DataFrame, keys: list[str], order: list[str], specs: Specs) -> DataFrame:
    y = df.select("*", *[_local(kind, e, keys, order).alias(f"_kr_{n}") for n, (kind, e) in specs.items()])
    return y.select(*_kept(df, specs), *[
        (F.col(f"_kr_{n}")["v"] if kind in ("prev", "next") else F.col(f"_kr_{n}")).alias(n)
        for n, (kind, _) in specs.items()])


def _total(kind: str, e: Column | None, order: list[str]) -> Column:
    """What a range passes on to the others of its key."""
    at = F.struct(*[F.col(c) for c in order])
    if kind == "count":
        return F.count(F.lit(1))
    if kind == "sum":
        return F.sum(e)
    if kind in ("max", "max_before"):
        return F.max(e)
    if kind == "min":
        return F.min(e)
    if kind == "last":  # rows with a null value get a null place, which max_by skips
        return F.max_by(e, F.when(e.isNotNull(), at))
    if kind == "first":
        return F.min_by(e, F.when(e.isNotNull(), at))
    return (F.max_by if kind == "prev" else F.min_by)(F.struct(e.alias("v")), at)


def _offset(kind: str, t: str, keys: list[str]) -> Column:
    """The combination of the totals of the other ranges that a row of a range needs."""
    w, _, before = _windows(keys, [_PART])
    if kind in ("count", "sum"):
        return F.sum(t).over(before)
    if kind in ("max", "max_before"):
        return F.max(t).over(before)
    if kind == "min":
        return F.min(t).over(before)
    if kind == "last":
        return F.last(t, ignorenulls=True).over(before)
    if kind == "first":
        return F.first(t, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (F.lag if kind == "prev" else F.lead)(t).over(w)


def _combined(kind: str, here: Column, there: Column) -> Column:
    if kind == "count":
        return here + F.coalesce(there, F.lit(0))
    if kind == "sum":  # null only when every value so far is null, as a plain running sum
        return F.coalesce(here + there, here, there)
    if kind in ("max", "max_before"):
        return F.greatest(here, there)
    if kind == "min":
        return F.least(here, there)
    if kind == "last":
        return F.coalesce(here, there)
    if kind == "first":
        return there
    return F.coalesce(here, there)["v"]


def _split(rows: DataFrame, columns: list[str], keys: list[str], order: list[str], specs: Specs) -> DataFrame:
    group = [*keys, _PART]
    totals = rows.groupBy(*group).agg(*[_total(kind, e, order).alias(f"_kr_t_{n}") for n, (kind, e) in specs.items()])
    offsets = totals.select(*[F.col(c).alias(f"_kr_k_{c}") for c in group],
                            *[_offset(kind, f"_kr_t_{n}", keys).alias(f"_kr_o_{n}") for n, (kind, _) in specs.items()])
    local = rows.select("*", *[_local(kind, e, group, order).alias(f"_kr_{n}") for n, (kind, e) in specs.items()])
    z = local.join(offsets, _all(F.col(c).eqNullSafe(F.col(f"_kr_k_{c}")) for c in group))
    return z.select(*_kept(columns, specs), *[
        _combined(kind, F.col(f"_kr_{n}"), F.col(f"_kr_o_{n}")).alias(n) for n, (kind, _) in specs.items()])


def time_bucket(ts: Column | str, duration: str) -> Column:
    """Start of the tumbling bucket holding ``ts`` (works for TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.window(ts, duration).start
