"""Streaming forms of the windowed, joined and counted queries (S tier).

Inputs are streaming DataFrames with TIMESTAMP event times (``to_event_time``); every
windowed query declares its watermark (T2: zero lateness = ``"0 seconds"``; T3:
bounded disorder = the bound). Outputs use append mode except the running word count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flat_window
from ..operators import windows as W


def watermarked(df: DataFrame, ts: str, lateness: str = "0 seconds") -> DataFrame:
    return df.withWatermark(ts, lateness)


def sliding_count_stream(bids: DataFrame, size: str, slide: str, lateness: str = "0 seconds") -> DataFrame:
    """W3 (Q5): append mode, each window emitted once when the watermark passes its end."""
    return W.sliding_count(watermarked(bids, "date_time", lateness), "auction", "date_time", size, slide)


def sliding_count_sql_stream(bids: DataFrame, view: str = "eddy_bid_stream", lateness: str = "0 seconds") -> DataFrame:
    """W3 (Q5) as streaming SQL: the batch SQL text over a watermarked streaming view."""
    from ..plans.sql import Q5_OVER
    watermarked(bids, "date_time", lateness).createOrReplaceTempView(view)
    return bids.sparkSession.sql(Q5_OVER.format(bid=view))


def session_count_stream(bids: DataFrame, gap: str, lateness: str = "0 seconds") -> DataFrame:
    """W5 (Q11): ``session_window`` in append mode (merged map-side per partition)."""
    return W.session_count(watermarked(bids, "date_time", lateness), "bidder", "date_time", gap)


def join_stream(auctions: DataFrame, persons: DataFrame) -> DataFrame:
    """J1 (Q3): stream-stream inner join, both sides kept for ever (no watermark), as
    the query is specified; state grows with the input."""
    j = auctions.join(persons, auctions.seller == persons.id)
    return j.select(persons.name, persons.city, persons.state, auctions.id.alias("auction_id"))


def window_join_stream(persons: DataFrame, auctions: DataFrame, size: str) -> DataFrame:
    """J4 (Q8): both sides watermarked; the window struct is a join key, so each side's
    state is dropped once the watermark passes the window."""
    p = persons.select("id", "name", F.window("date_time", size).alias("pw"))
    a = auctions.select("seller", "reserve", F.window("date_time", size).alias("aw"))
    j = p.join(a, (p.id == a.seller) & (p.pw == a.aw))
    return j.select("id", "name", "reserve", *flat_window("pw"))


def word_count_stream(tokens: DataFrame) -> DataFrame:
    """A2: running keyed sum; in update mode every batch emits the changed totals."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
