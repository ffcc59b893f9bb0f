"""Filters, projections and the nested record built from an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the two keyed-state operators whose tag the nested record carries.
KRYO_STATE_OPERATOR = "keyed_state_generic"
AVRO_STATE_OPERATOR = "keyed_state_schema"


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """P1."""
    return df.filter(F.col(column).isin(values))


def complex_payload(tag: str | Column, key="key", event_time="event_time",
                    seq="sequence_number", payload="payload") -> Column:
    """Event -> struct(event_time, [str(key), payload], tag, {sequence_number})."""
    t = F.lit(tag) if isinstance(tag, str) else tag
    return F.struct(
        F.col(event_time).alias("event_time"),
        F.array(F.col(key).cast("string"), F.col(payload)).alias("string_list"),
        t.alias("str_payload"),
        F.struct(F.col(seq).alias("sequence_number")).alias("inner_payload"),
    )


def flatten_payload(c: str = "state") -> list[Column]:
    return [F.col(f"{c}.event_time").alias("event_time"),
            F.array_join(F.col(f"{c}.string_list"), ",").alias("string_list"),
            F.col(f"{c}.str_payload").alias("str_payload"),
            F.col(f"{c}.inner_payload.sequence_number").alias("inner_sequence_number")]
