"""Sinks K1-K6."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import file_system


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """K5 batch form: one live row per key, the last in ``order`` wins (upsert)."""
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]),
                                       F.struct(*[F.col(c) for c in order])).alias("_row"))
    return g.select(*keys, "_row.*")


UPSERT_BUCKETS = 64


def upsert_writer(path: str, keys: list[str], order: list[str], buckets: int = UPSERT_BUCKETS):
    """K5 stream form: a ``foreachBatch`` function keeping one live row per key.

    The snapshot is kept in ``buckets`` parts by a hash of the key. A batch rewrites the
    parts its keys fall into, each under a new version, then commits a list that names the
    version of every part (``commit=<batch>``); other parts are left where they are, so a
    batch costs the parts it touches. Re-running a batch rewrites the same versions and the
    same list, so a replay after failure gives the same result (exactly-once). A batch
    whose predecessor has no committed list raises: going on from an empty state would
    lose every key. Versions that neither of the last two lists names are deleted after
    the commit. Readers take the newest committed list (``latest_snapshot``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before: dict[int, int] = {}
        if batch_id > 0:
            if not committed(spark, path, batch_id - 1):
                raise RuntimeError(f"{path} has no committed snapshot of batch {batch_id - 1}")
            before = _versions(spark, path, batch_id - 1)
        cols = [*keys, *[c for c in batch.columns if c not in keys]]
        new = batch.select(*cols, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_part")).persist()
        try:
            touched = sorted(r[0] for r in new.select("_part").distinct().collect())  # at most ``buckets``
            old = [_part_path(path, before[p], p) for p in touched if p in before]
            rows = new
            if old:
                rows = spark.read.parquet(*old).withColumn(
                    "_part", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).unionByName(new)
            if touched:
                (latest_per_key(rows, [*keys, "_part"], order).repartition(len(touched), "_part")
                 .write.mode("overwrite").partitionBy("_part").parquet(f"{path}/v={batch_id:012d}"))
        finally:
            new.unpersist()
        after = before | {p: batch_id for p in touched}
        listing = spark.createDataFrame(sorted(after.items()), "part int, version long")
        listing.coalesce(1).write.mode("overwrite").parquet(_commit_path(path, batch_id))
        live = {f"v={v:012d}" for v in (*after.values(), *before.values())} | {
            f"commit={b:012d}" for b in (batch_id, batch_id - 1)}
        fs, p = file_system(spark, path)
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if name not in live and name.startswith(("v=", "commit=")):
                fs.delete(status.getPath(), True)

    return write


def _part_path(path: str, version: int, part: int) -> str:
    return f"{path}/v={version:012d}/_part={part}"


def _commit_path(path: str, batch_id: int) -> str:
    return f"{path}/commit={batch_id:012d}"


def committed(spark, path: str, batch_id: int) -> bool:
    fs, p = file_system(spark, f"{_commit_path(path, batch_id)}/_SUCCESS")
    return fs.exists(p)


def _versions(spark, path: str, batch_id: int) -> dict[int, int]:
    return {r["part"]: r["version"] for r in spark.read.parquet(_commit_path(path, batch_id)).collect()}


def latest_snapshot(spark, path: str) -> DataFrame:
    """The rows of the newest committed snapshot."""
    fs, p = file_system(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    for name in reversed([n for n in names if n.startswith("commit=")]):
        batch_id = int(name.removeprefix("commit="))
        if committed(spark, path, batch_id):
            parts = [_part_path(path, v, part) for part, v in _versions(spark, path, batch_id).items()]
            if not parts:
                raise ValueError(f"the snapshot of batch {batch_id} in {path} holds no rows")
            return spark.read.parquet(*parts)
    raise ValueError(f"{path} holds no committed snapshot")


def to_message(df: DataFrame, key: str) -> DataFrame:
    """K5 message form: (key as text, JSON of the whole row), as an upsert topic takes it."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def with_latency(df: DataFrame, ts: str, name: str = "latency") -> DataFrame:
    """K3: per micro-batch, processing time minus event time (ms): count, median, p99, max.
    Read them from ``StreamingQueryProgress.observedMetrics[name]``."""
    lat = (F.unix_millis(F.current_timestamp()) - F.unix_millis(F.col(ts).cast("timestamp")))
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.percentile_approx(lat, 0.5).alias("p50_ms"),
                      F.percentile_approx(lat, 0.99).alias("p99_ms"),
                      F.max(lat).alias("max_ms"))


def create_table(spark, name: str, df: DataFrame, location: str) -> None:
    """K6 target: a parquet table with the frame's schema at a shared location."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{location}'")


def insert_select(spark, table: str, df: DataFrame, view: str) -> None:
    """K6 batch form: ``INSERT INTO table SELECT * FROM view``."""
    df.createOrReplaceTempView(view)
    spark.sql(f"INSERT INTO {table} SELECT * FROM {view}")


def insert_stream(df: DataFrame, table: str, checkpoint: str):
    """K6 stream form: append every micro-batch to the table (exactly-once commit log)."""
    q = (df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
           .trigger(availableNow=True).toTable(table))
    q.awaitTermination()
    return q
