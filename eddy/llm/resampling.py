"""Target-distribution importance resampling with segment deduplication.

Texts are described by hashed counts of their runs of one to three words. A text falls
apart at its newlines: the runs inside a line are found once for each distinct line of the
whole table and counted as often as the line occurs; the few runs that reach over a line's
end are found per text and added. The same units then carry the weights: a text's weight
is the sum over its lines of the line's weight, and of what reaches over the ends.

A bucket's gain is the log ratio of its smoothed shares in the target and in the texts, in
thousandths, rounded down. Score = weight + Gumbel noise from a hash of the id, so the
highest scores are a weighted sample without replacement (Gumbel top-k).

The buckets of a run's CRC-32 are computed for whole batches: a word's value byte by byte
over all words at once, a run's by moving the value of what comes before past the bytes of
the next word (CRC-32 is linear, so this is a table lookup per byte of the value).

Defined cases: a null text has no words; a null id is hashed as the empty string and comes
last among equals; rows alike in id and text get the same weight and score and neighbouring
ranks; an empty table gives no rows, an empty target no counts (its share is the smoothing
alone). Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm import textkernel as K
from eddy.llm.scratch import Scratch

BUCKETS = 10_000
#: A line has a word if it holds a letter, a digit or anything beyond ASCII.
HAS_WORD = r"[0-9A-Za-z]|[^\x00-\x7F]"

_U = np.uint32


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=_U)
    for _ in range(8):
        t = np.where(t & _U(1), (t >> _U(1)) ^ _U(0xEDB88320), t >> _U(1))
    return t


_TABLE = _crc_table()
_SHIFTS = 64  # words of fewer bytes move a value by one lookup


def _shift_tables() -> np.ndarray:
    """[n, byte of the value, its content] -> the value moved past n zero bytes."""
    out = np.zeros((_SHIFTS, 4, 256), dtype=_U)
    for j in range(4):
        out[0, j] = np.arange(256, dtype=_U) << _U(8 * j)
    for n in range(1, _SHIFTS):
        out[n] = (out[n - 1] >> _U(8)) ^ _TABLE[out[n - 1] & _U(255)]
    return out


_SHIFT = _shift_tables()


def _moved(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRC registers moved past ``n`` zero bytes each."""
    value = value.copy()
    left = n.copy()
    todo = slice(None)
    while True:
        k = np.minimum(left[todo], _SHIFTS - 1)
        v = value[todo]
        value[todo] = (_SHIFT[k, 0, v & _U(255)] ^ _SHIFT[k, 1, v >> _U(8) & _U(255)]
                       ^ _SHIFT[k, 2, v >> _U(16) & _U(255)] ^ _SHIFT[k, 3, v >> _U(24)])
        left[todo] -= k
        todo = np.flatnonzero(left)
        if not len(todo):
            return value


def _word_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of every word."""
    n = end - start
    out = np.full(len(start), 0xFFFFFFFF, dtype=_U)
    order = np.argsort(-n, kind="stable")
    size, begin = n[order], start[order]
    long = int(np.searchsorted(-size, -(_SHIFTS - 1), side="left"))  # those of 64 bytes or more come first
    state = out[order]
    at = 0
    live = len(order)
    while at < _SHIFTS:
        live = int(np.searchsorted(-size, -at, side="left"))  # words of more than ``at`` bytes
        if live <= long:
            break
        s = state[long:live]
        state[long:live] = (s >> _U(8)) ^ _TABLE[(s ^ data[begin[long:live] + at]) & _U(255)]
        at += 1
    out[order] = ~state
    for i in order[:long]:
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes())
    return out


def _joined(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of "first second" from both values; ``size``: bytes of the second."""
    spaced = ~((~first >> _U(8)) ^ _TABLE[(~first ^ _U(0x20)) & _U(255)])
    return _moved(spaced, size) ^ second


@dataclass
class Runs:
    """Buckets of the runs of words of a batch of texts: ``bucket[first[d]:first[d + 1]]``."""

    bucket: np.ndarray
    first: np.ndarray
    words: np.ndarray


def runs(column: pa.Array, across: bool, buckets: int = BUCKETS) -> Runs:
    """The runs of one to three words of every text, or (``across``) only those of them
    that reach over a newline."""
    w = K.words(column, lower=True, hashes=False, gaps=K.NOT_ALNUM)
    n = len(column)
    counts = np.diff(w.first)
    doc = np.repeat(np.arange(n), counts)
    size = w.end - w.start
    data = K.LOWER[w.data]
    more = [doc[k:] == doc[:-k] if len(doc) > k else np.zeros(0, bool) for k in (1, 2)]
    if across:
        line = np.searchsorted(np.flatnonzero(data == 10), w.start)
        more = [m & (line[k:] != line[:-k]) if len(m) else m for k, m in zip((1, 2), more)]
        used = np.zeros(len(doc), dtype=bool)
        for k, m in zip((1, 2), more):
            for j in range(k + 1):
                used[j:j + len(m)] |= m
        crc = np.zeros(len(doc), dtype=_U)
        crc[used] = _word_crcs(data, w.start[used], w.end[used])
    else:
        crc = _word_crcs(data, w.start, w.end)
    found, of = ([], []) if across else ([crc], [doc])
    pair = np.zeros(max(0, len(doc) - 1), dtype=_U)
    three = np.flatnonzero(more[1])
    two = np.union1d(np.flatnonzero(more[0]), three)
    pair[two] = _joined(crc[two], crc[two + 1], size[two + 1])
    for at, value in ((np.flatnonzero(more[0]), None), (three, _joined(pair[three], crc[three + 2], size[three + 2]))):
        found.append(pair[at] if value is None else value)
        of.append(doc[at])
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    bucket = (np.concatenate(found)[order] % _U(buckets)).astype(np.uint16)
    return Runs(bucket, np.searchsorted(of[order], np.arange(n + 1)), counts)


def _packed(r: Runs) -> pa.Array:
    """The buckets of every text as bytes (two for each run)."""
    data = r.bucket.astype("<u2").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(r.words), [
        None, pa.py_buffer((2 * r.first).astype(np.int32).tobytes()), pa.py_buffer(data)])


def _units(df: DataFrame, across: bool, buckets: int) -> DataFrame:
    """``df`` (columns, then ``text``) with n_words and buckets in place of the text."""
    head = [f for f in df.schema.fields if f.name != "text"]
    names = [*(f.name for f in head), "n_words", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.num_columns - 1)
            for at, to in K.parts(text, 2 << 20):
                r = runs(text.slice(at, to - at), across, buckets)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(at, to - at) for i in range(b.num_columns - 1)),
                     pa.array(r.words, pa.int64()), _packed(r)], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in head), "n_words long, buckets binary"])
    return df.select(*(f.name for f in head), "text").mapInArrow(run, schema)


def _key(text: Column) -> list[Column]:
    """Two 64-bit hashes: texts are told apart by 128 bits."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


@dataclass
class Segmented:
    """A table's texts in units: distinct lines with their occurrences (h1, h2, n, n_words,
    buckets), what reaches over line ends per text (id, t1, t2, n_words, buckets; n_words of
    the whole text), and each text's lines (id, t1, t2, h1, h2, n)."""

    lines: DataFrame
    texts: DataFrame
    links: DataFrame


def segment(docs: DataFrame, scratch: Scratch, id_: Column, text: Column, buckets: int = BUCKETS) -> Segmented:
    t1, t2 = _key(F.col("text"))
    rows = (docs.select(id_.alias("id"), F.coalesce(text, F.lit("")).alias("text"))
            .select("id", t1.alias("t1"), t2.alias("t2"), "text"))
    lines = rows.select("id", "t1", "t2", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(HAS_WORD))
    distinct = lines.groupBy(F.col("line").alias("text")).agg(F.count("*").alias("n"))
    distinct = distinct.select(*_key(F.col("text")), "n", "text")
    links = lines.groupBy("id", "t1", "t2", *_key(F.col("line"))).agg(F.count("*").alias("n"))
    return Segmented(scratch.table(_units(distinct, False, buckets), "lines"),
                     scratch.table(_units(rows, True, buckets), "texts"), links)


def counts(s: Segmented, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): runs in each bucket; a distinct line's runs count once per occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            raw, offsets = K.text_bytes(b.column(1))
            flat = raw.view("<u2")
            times = np.repeat(b.column(0).to_numpy(zero_copy_only=False), np.diff(offsets) // 2)
            once = times == 1
            total += np.bincount(flat[once], minlength=buckets)
            np.add.at(total, flat[~once], times[~once])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    units = s.lines.select("n", "buckets").unionAll(s.texts.select(F.lit(1).cast("long"), "buckets"))
    return units.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, spark: SparkSession, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 * ln(((t+1)(S+B)) / ((s+1)(T+B))))."""
    s, t = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    all_ = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    x = all_.join(s, "bucket", "left").join(t, "bucket", "left").fillna(0, ["s", "t"])
    x = x.crossJoin(F.broadcast(x.agg(F.sum("s").alias("S_"), F.sum("t").alias("T_"))))  # one row
    d = lambda c: F.col(c).cast("double")
    ratio = ((d("t") + 1) * (d("S_") + buckets)) / ((d("s") + 1) * (d("T_") + buckets))
    return x.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def _weights(units: DataFrame, gain: np.ndarray) -> DataFrame:
    """``units`` with a weight in place of its buckets (its last column)."""
    head = units.schema.fields[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = K.text_bytes(b.column(b.num_columns - 1))
            total = np.concatenate([[0], np.cumsum(gain[raw.view("<u2")])])
            w = total[offsets[1:] // 2] - total[offsets[:-1] // 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(w, pa.int64())],
                                             names=[*(f.name for f in head), "weight"])

    return units.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in head), "weight long"]))


def weigh(s: Segmented, gain: np.ndarray) -> DataFrame:
    """(id, t1, t2, copies, n_words, weight): every text with its rows' number."""
    line = _weights(s.lines.select("h1", "h2", "buckets"), gain).withColumnRenamed("weight", "w")
    inner = s.links.join(line, ["h1", "h2"]).select(
        "id", "t1", "t2", F.lit(0).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_words"),
        (F.col("n") * F.col("w")).alias("weight"))
    across = _weights(s.texts.select("id", "t1", "t2", "n_words", "buckets"), gain).select(
        "id", "t1", "t2", F.lit(1).cast("long").alias("copies"), "n_words", "weight")
    return (inner.unionAll(across).groupBy("id", "t1", "t2")
            .agg(F.sum("copies").alias("copies"), F.max("n_words").alias("n_words"), F.sum("weight").alias("weight"))
            .withColumn("weight", F.expr("weight div copies")))


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise from the id, in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, scratch: Scratch, eligible: Column) -> DataFrame:
    """``rows`` (id, t1, t2, copies, score, ...) with ``before``: eligible rows of a higher
    score (ties: smaller id, null last, then the text's hash). Rows are dealt to sampled
    ranges of that order; a range's offset is the sum of the ranges before it."""
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("t1"), F.asc("t2")]
    dealt = scratch.table(rows.where(eligible).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt")
    # One number for each range: as many as there are shuffle partitions.
    per = sorted(map(tuple, dealt.groupBy("part").agg(F.sum("copies")).collect()))
    offset = scratch.spark.createDataFrame(
        [(part, sum(x[1] for x in per[:i])) for i, (part, _) in enumerate(per)], "part int, offset long")
    inside = F.sum("copies").over(Window.partitionBy("part").orderBy(*order)) - F.col("copies")
    drawn = dealt.withColumn("inside", inside).join(F.broadcast(offset), "part")
    drawn = drawn.withColumn("before", F.col("inside") + F.col("offset")).drop("part", "offset", "inside")
    return drawn.unionByName(rows.where(~eligible).withColumn("before", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, spark: SparkSession, percent: int = 5, least: int = 20, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """id, n_features, weight, score, rank of every row. Of the rows with ``least`` words or
    more the ``percent`` in a hundred of highest score have a rank, the others null."""
    scratch = Scratch(spark, "resampling")
    own = segment(docs, scratch, F.col(id_col), F.col(text_col))
    wanted = segment(target, scratch, F.lit(0), F.col(target_col))
    gain = np.zeros(BUCKETS, dtype=np.int64)
    for r in gains(counts(own), counts(wanted), spark).collect():  # BUCKETS rows
        gain[r["bucket"]] = r["gain"]
    n = F.col("n_words")
    rows = weigh(own, gain).withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    rows = scratch.table(rows, "scores")
    many = rows.where(n >= least).agg(F.sum("copies")).first()[0] or 0
    rank = F.col("before") + F.col("copy") + 1
    return (ranked(rows, scratch, n >= least)
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select(F.col("id").alias(id_col),
                    (n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))).alias("n_features"), "weight", "score",
                    F.when(rank <= percent * many // 100, rank).alias("rank")))
