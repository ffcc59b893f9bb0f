"""JSON message logs (raw key, JSON value), as a message-queue source delivers them.

The decode step works on any ``(key binary, value binary)`` frame: a kafka source
(``readStream.format("kafka")``, needs the connector package) or files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Row -> (key = key as text bytes, value = JSON bytes)."""
    return df.select(F.col(key).cast("string").cast("binary").alias("key"),
                     F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def decode(msgs: DataFrame, schema: T.StructType, key_type: str = "bigint") -> DataFrame:
    """(key, value) -> raw key + the declared JSON fields (no inference)."""
    return msgs.select(F.col("key").cast("string").cast(key_type).alias("msg_key"),
                       F.from_json(F.col("value").cast("string"), schema).alias("_v")).select("msg_key", "_v.*")


def decode_checked(msgs: DataFrame, schema: T.StructType, key_type: str = "bigint") -> DataFrame:
    """``decode`` that keeps what can't be decoded: the message's columns, ``msg_key``, the
    declared fields and ``broken``, which says why a message is one of the quarantine (else
    null): no value, a key that isn't a ``key_type``, or a value that isn't JSON of the
    declared fields. Works on streams."""
    text = F.col("value").cast("string")
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    read = msgs.select("*", F.expr(f"try_cast(cast(key as string) as {key_type})").alias("msg_key"),
                       F.from_json(text, wide, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_v"))
    why = (F.when(F.col("value").isNull() | (F.trim(text) == ""), "no value")
           .when(F.col("key").isNotNull() & F.col("msg_key").isNull(), "key")
           .when(F.col("_v._corrupt").isNotNull() | F.col("_v").isNull(), "value"))
    return read.withColumn("broken", why).select(
        *msgs.columns, "msg_key", *[F.col(f"_v.{f.name}").alias(f.name) for f in schema.fields], "broken")


def sorted_out(good, quarantine: str):
    """A ``foreachBatch`` writer for ``decode_checked`` rows: the broken ones of a batch go to
    ``quarantine``/batch=N (written over when the batch is repeated), the others to the
    writer ``good`` (batch, id), without the message's bytes."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            (batch.where("broken is not null").select("key", "value", "broken")
             .write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch_id}"))
            good(batch.where("broken is null").drop("key", "value", "broken"), batch_id)
        finally:
            batch.unpersist()
    return write


def kafka_reader(spark, servers: str, topic: str):
    """S7 over kafka: earliest offsets (needs the spark-sql-kafka package on the classpath)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest").load())
