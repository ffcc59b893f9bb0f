"""Threshold-scaled document sketches (native).

A text's sketch holds every hash of its five-word shingles that falls into the lowest
1/``scale`` of the hash range. Sketches of any two texts are samples of the same hashes,
so they merge by union and estimate containment however unequal the texts are. A text
whose shingles all miss the range keeps its least hash, so that no text with words has an
empty sketch; the rule holds for merged sketches too.

Defined cases: a null text counts as empty; a text of one to four words has one shingle,
its whole sequence; a text without words has an empty sketch, alike (1.0) to other empty
ones and to nothing else. Null ids come first in the order of ids, rows of equal ids are
ordered by text; repeated rows stay. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: Rows of neighbouring ids are dealt out in this many buckets at most (bounds are read by the driver).
MOST_BUCKETS = 50_000


def word_hashes(text: Column) -> Column:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(words: Column, width: int = SHINGLE) -> Column:
    """Hashes of the shingles of an array of word hashes, repeats included. ``words`` has
    to be a plain column: it is read ``width`` times for each shingle."""
    n = F.size(words)
    many = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))
    return F.when(n >= width, many).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def sketch(hashes: Column, scale: int) -> Column:
    """The retained hashes, distinct and sorted. ``hashes`` has to be a plain column."""
    limit = -(1 << 63) + (1 << 64) // scale
    low = F.filter(hashes, lambda h: h < F.lit(limit))
    return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).when(
        F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text_col: str, name: str, scale: int) -> DataFrame:
    """``df`` with a column ``name``: the sketch of ``text_col``."""
    return (df.withColumn("_w", word_hashes(F.col(text_col))).withColumn("_h", shingle_hashes(F.col("_w")))
            .withColumn(name, sketch(F.col("_h"), scale)).drop("_w", "_h"))


def merged(a: Column, b: Column, scale: int) -> Column:
    """The sketch of two texts together, from their sketches."""
    return sketch(F.array_union(a, b), scale)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, F.lit(1.0)).otherwise(both / any_)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def fingerprint(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), " ")


def id_bounds(df: DataFrame, id_col: str, weight: Column, bucket_bytes: int) -> list[int]:
    """Sorted least ids of ranges of about ``bucket_bytes`` each (sampled; nulls left out)."""
    total = df.agg(F.sum(weight).alias("w"), F.count(id_col).alias("n")).first()
    if not total["n"]:
        return []
    count = max(1, min(MOST_BUCKETS, total["n"], math.ceil((total["w"] or 0) / bucket_bytes)))
    ids = df.select(F.col(id_col).alias("k")).where(F.col("k").isNotNull()).repartitionByRange(count, "k")
    return sorted({r["low"] for r in ids.groupBy(F.spark_partition_id()).agg(F.min("k").alias("low")).collect()})


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or below the key (0 for a null key), by
    halving steps over an array literal."""
    if not bounds:
        return F.lit(0)
    values = F.lit(bounds)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda pos, s: F.when(
        (pos + s <= len(bounds)) & (F.get(values, pos + s - 1) <= key), pos + s).otherwise(pos))


def with_next(df: DataFrame, id_col: str, carried: Column, name: str, weight: Column,
              bucket_bytes: int = 4 << 20) -> DataFrame:
    """``df`` with a column ``name``: ``carried`` (a struct) of the row next in the order
    of ``id_col`` and ``carried``; the last row gets the first row's.

    One shuffle of the rows: ids are cut into ranges of about ``bucket_bytes`` at sampled
    bounds, the first row of each range is put behind the last one of the range before.
    """
    bounds = id_bounds(df, id_col, weight, bucket_bytes)
    rows = df.withColumn("_c", carried).withColumn("_b", bucket_of(F.col(id_col), bounds))
    low = F.concat(F.array(F.lit(None).cast("bigint")), F.lit(bounds).cast("array<bigint>")) if bounds else F.array(
        F.lit(None).cast("bigint"))
    heads = rows.where(F.col(id_col).eqNullSafe(F.get(low, F.col("_b")))).groupBy("_b").agg(F.min("_c").alias("_c"))
    first = 0 if rows.where(F.col(id_col).isNull()).limit(1).count() else 1
    before = F.when(F.col("_b") == first, F.lit(len(bounds))).otherwise(F.col("_b") - 1)
    sentinels = heads.select(
        *[F.lit(None).cast(t).alias(c) for c, t in df.dtypes], "_c", before.alias("_b"), F.lit(1).alias("_tail"))
    every = rows.withColumn("_tail", F.lit(0)).unionByName(sentinels)
    order = Window.partitionBy("_b").orderBy("_tail", id_col, "_c")
    return every.withColumn(name, F.lead("_c").over(order)).where(F.col("_tail") == 0).drop("_c", "_b", "_tail")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = 8) -> DataFrame:
    """Per row: id, n_chars, fingerprint; of the edited text (its second half replaced by
    the start of the next row's text) edited_sha256 and edited_fingerprint; near_edited
    and near_next (likeness) and contained_edited, contained_next (containment)."""
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = with_sketch(own, "text", "sketch", scale)
    rows = with_next(own, "id", F.struct("text", "sketch"), "next", F.octet_length("text"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half))
    rows = rows.select("id", n.alias("n_chars"), "sketch", F.col("next.sketch").alias("next"), edited.alias("edited"))
    rows = with_sketch(rows, "edited", "edited_sketch", scale)
    return rows.select(
        F.col("id").alias(id_col), F.col("n_chars").cast("long"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_edited"),
        containment(F.col("sketch"), F.col("next")).alias("contained_next"))
