"""Joins J1-J4 of the auction queries.

Arrival order, which the reference takes from the order records reach the operator, is
an explicit column list here (``date_time``, persons before auctions on a tie, id, copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flat_window
from ..plans.keyed import keyed_running

PERSON_FIELDS = ["name", "city", "state"]


def incremental_join(auctions: DataFrame, persons: DataFrame) -> DataFrame:
    """Every (auction, person) pair with person.id = auction.seller; both sides kept
    for ever. A hot seller is split by AQE's skew-join handling (sort-merge join)."""
    a, p = auctions.alias("a"), persons.alias("p")
    return a.join(p, F.col("a.seller") == F.col("p.id")).select(
        "p.name", "p.city", "p.state", F.col("a.id").alias("auction_id"))


def _with_copy(df: DataFrame) -> DataFrame:
    return df if "copy" in df.columns else df.withColumn("copy", F.lit(0))


def _arrivals(auctions: DataFrame, persons: DataFrame) -> DataFrame:
    """Both inputs as one tagged table of arrivals, persons before auctions on a tie."""
    p, a = _with_copy(persons), _with_copy(auctions)
    person = F.struct(*PERSON_FIELDS)
    kind = p.select(person).schema[0].dataType
    return (p.select(F.col("id").alias("k"), "date_time", F.lit(0).alias("side"), F.col("id").alias("rid"), "copy",
                     person.alias("person"))
             .unionByName(a.select(F.col("seller").alias("k"), "date_time", F.lit(1).alias("side"),
                                   F.col("id").alias("rid"), "copy", F.lit(None).cast(kind).alias("person"))))


ARRIVAL_ORDER = ["date_time", "side", "rid", "copy"]


def emit_once_first(auctions: DataFrame, persons: DataFrame, split_rows: int | None = None) -> DataFrame:
    """A stored person is never replaced, so every auction meets its key's first person.

    One keyed scan over the arrivals; a hot seller's arrivals are split by the scan."""
    r = keyed_running(_arrivals(auctions, persons), ["k"], ARRIVAL_ORDER, {"first": ("first", F.col("person"))}, split_rows)
    return r.filter((F.col("side") == 1) & F.col("first").isNotNull() & F.col("k").isNotNull()).select(
        "first.*", F.col("rid").alias("auction_id"))


def emit_once_last(auctions: DataFrame, persons: DataFrame, dedupe_waiting: bool = False,
                   split_rows: int | None = None) -> DataFrame:
    """An auction meets the latest person of its key that arrived before it; with no
    such person it waits for the key's first person. ``dedupe_waiting`` keeps waiting
    auction ids in a set (repeats collapse) instead of a list.

    One keyed scan over the arrivals gives both the latest person before and the key's
    first person; no join follows, and a hot seller's arrivals are split by the scan."""
    r = keyed_running(_arrivals(auctions, persons), ["k"], ARRIVAL_ORDER,
                      {"before": ("last", F.col("person")), "first": ("first", F.col("person"))}, split_rows)
    out = r.filter((F.col("side") == 1) & F.col("first").isNotNull() & F.col("k").isNotNull()).select(
        F.coalesce("before", "first").alias("person"), "k", "rid", F.col("before").isNull().alias("_waited"),
        "date_time", "copy")
    if dedupe_waiting:
        # waiting ids form a set: repeats of one id while waiting collapse; auctions that met a
        # stored person stay one row per arrival
        out = (out.withColumn("_dk", F.when(~F.col("_waited"), F.struct("date_time", "copy")))
                  .dropDuplicates(["k", "rid", "_dk"]))
    return out.select("person.*", F.col("rid").alias("auction_id"))


def window_join(persons: DataFrame, auctions: DataFrame, size: str) -> DataFrame:
    """Pairs with person.id = auction.seller inside the same tumbling window.

    The window start is part of the join key, so a hot key is split by window."""
    p = persons.select("id", "name", F.window("date_time", size).alias("_w")).select("id", "name", *flat_window("_w"))
    a = auctions.select("seller", "reserve", F.window("date_time", size).alias("_w")).select(
        "seller", "reserve", *flat_window("_w"))
    j = p.join(a, (p.id == a.seller) & (p.window_start == a.window_start))
    return j.select(p.id, p.name, a.reserve, p.window_start, p.window_end)
