"""Fixed record schemas (no inference, no evolution)."""

from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("sequence_number", T.LongType()),
    T.StructField("payload", T.StringType()),
])

INNER_PAYLOAD = T.StructType([T.StructField("sequence_number", T.LongType())])

COMPLEX_PAYLOAD = T.StructType([
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("string_list", T.ArrayType(T.StringType())),
    T.StructField("str_payload", T.StringType()),
    T.StructField("inner_payload", INNER_PAYLOAD),
])

BID = T.StructType([
    T.StructField("auction", T.LongType()),
    T.StructField("bidder", T.LongType()),
    T.StructField("date_time", T.TimestampNTZType()),
])

AUCTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("seller", T.LongType()),
    T.StructField("reserve", T.DoubleType()),
    T.StructField("date_time", T.TimestampNTZType()),
])

PERSON = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("date_time", T.TimestampNTZType()),
])

# JSON message bodies of the re-keying SQL job (value format json, raw key).
AUCTION_MSG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("seller", T.LongType()),
])
PERSON_MSG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
])

WORD = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("n", T.LongType()),
])

# Source tables as supplied (only the columns the bindings read).
TABLE_COLUMNS = {
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "documents": ["doc_id", "text"],
}
