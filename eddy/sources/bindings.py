"""Record types of the auction and keyed-state jobs, bound to the supplied tables.

Every binding is a plain projection/join over the parquet scans, so Catalyst prunes
columns and pushes filters into the scan. Batch bindings keep TIMESTAMP_NTZ; streaming
callers cast with ``functions.to_event_time`` at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running
from .tables import read_table

# The person states the auction query keeps (Q3 filters OR, ID, CA),
# bound to three nations of the supplied tables.
Q3_STATES = ["NATION_1", "NATION_2", "NATION_3"]
# Fixed value: persons carry no time in the tables; this day and stride spread them
# over the order dates.
PERSON_EPOCH = "1995-01-01 00:00:00"
PERSON_STRIDE = 37
PERSON_DAYS = 2400

# Bucket of the skew-safe keyed scans (see plans.keyed) for event-time orders.


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events",
                      ["event_id", "ts", "user_id", "event_type", "value", "props"])


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bid(auction, bidder, date_time) + price and event_id (tie-break)."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    return e.select(
        F.get_json_object("props", "$.k").cast("bigint").alias("auction"),
        F.col("user_id").alias("bidder"),
        F.col("value").alias("price"),
        F.col("ts").alias("date_time"),
        "event_id",
    )


def auctions_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """auction(id, seller, reserve, date_time) from orders."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("seller"),
                    F.col("o_totalprice").alias("reserve"), F.col("o_orderdate").alias("date_time"))


def persons_q3(spark: SparkSession, sf_dir: str, states: list[str] | None = Q3_STATES) -> DataFrame:
    """S3: person(id, name, city, state, date_time) = customer x nation x region.

    nation (25 rows) and region (5 rows) are fixed-size dimension tables; the planner
    broadcasts them on its own size estimate, the customer side is never shuffled.
    """
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    if states is not None:
        n = n.filter(F.col("n_name").isin(states))  # P1, pushed into the nation scan
    p = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    return p.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("r_name").alias("city"), F.col("n_name").alias("state"),
        (F.lit(PERSON_EPOCH).cast("timestamp_ntz")
         + F.make_dt_interval(F.pmod(F.col("c_custkey") * PERSON_STRIDE, F.lit(PERSON_DAYS)).cast("int")))
        .alias("date_time"),
    )


def persons_q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 persons: signup events -> (id, name, date_time)."""
    e = read_table(spark, sf_dir, "events", ["ts", "user_id", "event_type"])
    return (e.filter(F.col("event_type") == "signup")
             .select(F.col("user_id").alias("id"),
                     F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
                     F.col("ts").alias("date_time")))


def auctions_q8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 auctions: purchase events -> (id, seller, reserve, date_time)."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return (e.filter(F.col("event_type") == "purchase")
             .select(F.col("event_id").alias("id"), F.col("user_id").alias("seller"),
                     F.col("value").alias("reserve"), F.col("ts").alias("date_time")))


def keyed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event(key, event_time, sequence_number, payload) + event_id.

    sequence_number = position of the event in its key's (ts, event_id) order, from 1,
    computed by the skew-safe keyed scan.
    """
    return number_events(plain_events(spark, sf_dir))


def plain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event without its sequence number: for operators whose result doesn't show it."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    return e.select(F.col("user_id").alias("key"), F.col("ts").alias("event_time"),
                    F.col("event_type").alias("payload"), "event_id")


def number_events(base: DataFrame) -> DataFrame:
    out = keyed_running(base, ["key"], ["event_time", "event_id"],
                        {"sequence_number": ("count", None)})
    return out.select("key", "event_time", F.col("sequence_number").cast("bigint"), "payload", "event_id")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document: (doc_id, line_no, line). Whole texts, no cap."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def trade_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph of all customers and suppliers linked by an order line.

    Vertex ids: customer 2*c_custkey, supplier 2*s_suppkey + 1 (one id space)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select((F.col("o_custkey") * 2).alias("src"), (F.col("l_suppkey") * 2 + 1).alias("dst")).distinct())


def order_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graph of all customers and their orders, naturally sparse: vertex ids customer
    2*o_custkey, order 2*o_orderkey + 1."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return o.select((F.col("o_custkey") * 2).alias("src"), (F.col("o_orderkey") * 2 + 1).alias("dst"))
