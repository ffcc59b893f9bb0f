"""Derived inputs that make the checks and join variants non-trivial.

Each fixture processes the whole table: it numbers every event and then injects a
known fault (a dropped slice, a repeated slice, a removed or an extra window), so
that the guarantee checks have something to find. Nothing is sampled or capped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running

# Fixed values of the injected faults.
REPEAT_EVERY = 50          # events with event_id % 50 = 0 arrive twice
MISSING_WINDOW_RANK = 5    # each key loses its 5th non-empty sliding window
PERSON_MOVE_DAYS = 400     # duplicate persons arrive 400 days later, another city
AUCTION_REPEAT_EVERY = 10  # auctions with id % 10 = 0 arrive twice
WRONG_TAG_EVERY = 7        # states of sequence % 7 = 0 carry the other operator's tag


def gapped(ev: DataFrame) -> DataFrame:
    """Numbered events without the errors of odd keys: gaps in the sequence."""
    return ev.filter((F.col("payload") != "error") | (F.pmod(F.col("key"), F.lit(2)) == 0)) \
             .withColumn("copy", F.lit(0))


def repeated(ev: DataFrame) -> DataFrame:
    """Adds a second copy, right after the first, of every event with event_id % 50 = 0."""
    base = ev if "copy" in ev.columns else ev.withColumn("copy", F.lit(0))
    again = base.filter(F.pmod(F.col("event_id"), F.lit(REPEAT_EVERY)) == 0).withColumn("copy", F.lit(1))
    return base.unionByName(again)


def drop_window(members: DataFrame, rank: int = MISSING_WINDOW_RANK, key="key", win="window_start",
                seq="sequence_number") -> DataFrame:
    """Removes each key's ``rank``-th non-empty window: windows are ranked by counting
    window changes along (window, sequence), in one exchange by key."""
    order = [win, seq]
    r = keyed_running(members, [key], order, {"_w": ("prev", F.col(win))})
    r = r.withColumn("_new", F.when(F.col("_w").isNull() | (F.col("_w") != F.col(win)), 1).otherwise(0))
    r = keyed_running(r, [key], order, {"_r": ("sum", F.col("_new"))})
    return r.filter(F.col("_r") != rank).select(*members.columns)


def extra_window(members: DataFrame, slide_ms: int, size_ms: int, key="key", win="window_start") -> DataFrame:
    """Adds, per key, one window after its last one that holds its first window's events."""
    g = members.groupBy(key).agg(F.min(win).alias("_first"), F.max(win).alias("_last"))
    # join on (key, first window): a hot key's rows are spread by window, not sent to one task
    old = members.join(g.withColumnRenamed("_first", win), [key, win])
    cols = [c for c in members.columns if c not in (win, "window_end")]
    new_start = F.col("_last") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(slide_ms / 1000.0).cast("decimal(18,6)"))
    new = old.select(*cols, new_start.alias(win)).withColumn(
        "window_end", F.col(win) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(size_ms / 1000.0).cast("decimal(18,6)")))
    return members.unionByName(new.select(*members.columns))


def moved_persons(persons: DataFrame) -> DataFrame:
    """Persons plus the same ids again, 400 days later, in another city."""
    base = persons.withColumn("copy", F.lit(0))
    moved = persons.select("id", "name", F.concat("city", F.lit("_2")).alias("city"), "state",
                           (F.col("date_time") + F.make_dt_interval(F.lit(PERSON_MOVE_DAYS))).alias("date_time"),
                           F.lit(1).alias("copy"))
    return base.unionByName(moved)


def repeated_auctions(auctions: DataFrame) -> DataFrame:
    base = auctions.withColumn("copy", F.lit(0))
    again = base.filter(F.pmod(F.col("id"), F.lit(AUCTION_REPEAT_EVERY)) == 0).withColumn("copy", F.lit(1))
    return base.unionByName(again)


def word_counts_changed(wc: DataFrame) -> DataFrame:
    """A changed copy of word counts: a tenth dropped, a tenth altered, a tenth added."""
    m = F.pmod(F.length("word"), F.lit(10))
    kept = wc.filter(m != 1).select("word", F.when(m == 2, F.col("n") + 1).otherwise(F.col("n")).alias("n"))
    added = wc.filter(m == 3).select(F.concat("word", F.lit("#")).alias("word"), "n")
    return kept.unionByName(added)
