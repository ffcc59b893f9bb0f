"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors become integers, floor(scale * x). An index row stores the integer vector and its
rotated code: ``LEVELS`` one-bit codes (signs of the rotated vector, of what is left after
half its largest component, and so on) with the alignments of the vector to the codes (the
least-squares scales). Scales and popcounts of XORed codes estimate an inner product; by
Cauchy and Schwarz it lies within |u| |r| + |s| |v'| of the estimate, where r and s are what
the codes leave of both vectors and v' is the coded part. Candidates are the rows whose
interval can reach the wanted scores; they are scored in integers, so results are exact
whatever the codes miss.

The search holds every anchor against every row, in blocks: rows are dealt to slots and
anchors to groups of bounded bytes, and each (slot, group) is a task of its own that gives
the best few rows of every anchor. Blocks are dealt by row number, so a label or a vector
that many rows share is spread like any other.

Defined cases: rows with a null id, a null label, a null vector or a null or non-finite
component take no part, nor do rows whose integer vector is 2^28 long or longer (their
scores might not fit). Vectors of different lengths never meet. Repeated rows count each as
a row; rows of the anchor's own id are no partners of it. An anchor without positives, or a
positive without negatives, gives no rows; so does an empty table. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm.scratch import Scratch

LEVELS = 5
#: Bytes of index rows in a slot, and of anchors in a group; pairs compared at once.
SLOT_BYTES, GROUP_BYTES, TILE = 12 << 20, 2 << 20, 1 << 20
_LONGEST = float(1 << 28)
_CODED = "row long, id long, label long, dim int, vector binary, code binary, scales binary, norm double, coded double, rest double"
_COLUMNS = [x.split()[0] for x in _CODED.split(", ")]


def quantised(rows: DataFrame, id_: Column, label: Column, vector: Column, scale: int = 256) -> DataFrame:
    """(id, label, q): integer vectors of the rows that take part."""
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    picked = rows.select(id_.cast("long").alias("id"), label.cast("long").alias("label"),
                         vector.cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(fine)
    whole = picked.select("id", "label", F.transform("x", lambda v: F.floor(v * F.lit(float(scale))).cast("double")).alias("x"))
    long = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    return whole.where(long < _LONGEST ** 2).select("id", "label", F.col("x").cast("array<int>").alias("q"))


def rotation(width: int, seed: int = 20) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def coded(vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS):
    """(codes [level, row, word], scales [row, level], norm, coded part, rest) of integer vectors."""
    n, dim = vectors.shape
    width = len(turn)
    v = np.zeros((n, width))
    v[:, :dim] = vectors
    v = v @ turn
    left = v.copy()
    signs = np.empty((levels, n, width))
    for level in range(levels):
        signs[level] = np.where(left >= 0, 1.0, -1.0)
        left -= np.abs(left).max(axis=1, keepdims=True) / 2 * signs[level]
    gram = np.einsum("ink,jnk->nij", signs, signs) + 1e-6 * width * np.eye(levels)
    aligned = np.einsum("ink,nk->ni", signs, v)
    scales = np.linalg.solve(gram, aligned[..., None])[..., 0].astype(np.float32).astype(float)
    part = np.einsum("ink,ni->nk", signs, scales)
    size = lambda x: np.sqrt((x * x).sum(axis=1))
    codes = np.packbits(signs > 0, axis=2).view(np.uint64)
    return codes, scales, size(v), size(part), size(v - part)


def index(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Index rows of (row, id, label, q)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                offsets = part.column(3).offsets.to_numpy()
                flat = part.column(3).values.to_numpy(zero_copy_only=False)
                dims = np.diff(offsets)
                for dim in np.unique(dims):
                    pick = np.flatnonzero(dims == dim)
                    vectors = flat[offsets[pick][:, None] + np.arange(dim)].astype(np.int32)
                    width = 64 * max(1, -(-int(dim) // 64))
                    turn = turns.setdefault(width, rotation(width) if width not in turns else turns[width])
                    codes, scales, norm, inner, rest = coded(vectors, turn, levels)
                    codes = np.ascontiguousarray(codes.transpose(1, 0, 2))
                    blob = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(i).take(pa.array(pick)) for i in range(3)),
                         pa.array(np.full(len(pick), dim, np.int32)), blob(vectors), blob(codes), blob(scales),
                         pa.array(norm), pa.array(inner), pa.array(rest)], names=_COLUMNS)

    return rows.select("row", "id", "label", "q").mapInArrow(run, _CODED)


class Side:
    """The index rows of one length in a block, as arrays."""

    def __init__(self, table: pa.Table, dim: int):
        get = lambda c: table.column(c).combine_chunks()
        raw = lambda c, kind: np.frombuffer(b"".join(get(c).to_pylist()), dtype=kind)
        n = table.num_rows
        self.row, self.id, self.label = (get(c).to_numpy(zero_copy_only=False) for c in ("row", "id", "label"))
        self.vector = raw("vector", np.int32).reshape(n, dim)
        self.scales = raw("scales", np.float64).reshape(n, -1)
        self.levels = self.scales.shape[1]
        self.codes = np.ascontiguousarray(raw("code", np.uint64).reshape(n, self.levels, -1).transpose(1, 2, 0))
        self.norm, self.coded, self.rest = (get(c).to_numpy(zero_copy_only=False) for c in ("norm", "coded", "rest"))


def intervals(a: Side, v: Side, at: slice) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner products of the anchors ``at`` with all rows."""
    width = 64 * v.codes.shape[1]
    scale_a, scale_v = a.scales[at].astype(np.float32), v.scales.astype(np.float32)
    estimate = np.zeros((len(scale_a), len(v.row)), dtype=np.float32)
    for level in range(v.levels):
        part = np.full(estimate.shape, 0, dtype=np.float32)
        part += (scale_a.sum(axis=1) * np.float32(width))[:, None]
        for k in range(a.levels):
            for word in range(v.codes.shape[1]):
                differ = np.bitwise_count(a.codes[k, word, at][:, None] ^ v.codes[level, word][None, :])
                part -= differ * (2 * scale_a[:, k])[:, None]
        part *= scale_v[:, level][None, :]
        estimate += part
    norm, rest = a.norm[at].astype(np.float32)[:, None], a.rest[at].astype(np.float32)[:, None]
    half = norm * v.rest.astype(np.float32)[None, :] + rest * v.coded.astype(np.float32)[None, :]
    half += 1 + np.float32(3e-5) * norm * v.norm.astype(np.float32)[None, :]  # what single precision may lose
    return estimate - half, estimate + half


def _scored(a: Side, v: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of anchors ``i`` and rows ``j``."""
    out = np.zeros(len(i), dtype=np.int64)
    step = max(1, (1 << 21) // max(1, a.vector.shape[1]))
    for s in range(0, len(i), step):
        k = slice(s, s + step)
        out[k] = np.einsum("ij,ij->i", a.vector[i[k]].astype(np.int64), v.vector[j[k]].astype(np.int64))
    return out


def _kth(x: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest allowed value of every line (-inf where there are fewer)."""
    if x.shape[1] < k:
        return np.full((len(x), 1), -np.inf, dtype=np.float32)
    return np.partition(np.where(allowed, x, -np.inf), x.shape[1] - k, axis=1)[:, [x.shape[1] - k]]


def _best(line: np.ndarray, score: np.ndarray, id_: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best (score down, id up) of every line."""
    order = np.lexsort((id_, -score, line))
    s = line[order]
    first = np.searchsorted(s, s)
    return order[np.arange(len(s)) - first < k]


def positives_in(a: Side, v: Side, count: int):
    """(anchor place, row place, score): the best rows of each anchor's label in the block."""
    step = max(1, TILE // max(1, len(v.row)))
    for s in range(0, len(a.row), step):
        at = slice(s, s + step)
        least, most = intervals(a, v, at)
        allowed = (a.label[at][:, None] == v.label[None, :]) & (a.id[at][:, None] != v.id[None, :])
        i, j = np.nonzero(allowed & (most >= _kth(least, allowed, count)))
        score = _scored(a, v, i + s, j)
        top = _best(i, score, v.id[j], count)
        yield i[top] + s, j[top], score[top]


def negatives_in(a: Side, v: Side, wanted: list[list[int]], count: int, low: int, high: int):
    """(anchor place, positive score, row place, score): the best rows of other labels whose
    score lies between ``low`` and ``high`` hundredths of a wanted positive's."""
    step = max(1, TILE // max(1, len(v.row)))
    for s in range(0, len(a.row), step):
        at = slice(s, s + step)
        least, most = intervals(a, v, at)
        other = a.label[at][:, None] != v.label[None, :]
        many = max(map(len, wanted[at]))
        seek = np.array([[*w, *[-1] * (many - len(w))] for w in wanted[at]], dtype=np.int64).reshape(-1, many)
        bottom, top = -(-low * seek // 100), high * seek // 100
        bottom[seek < 0], top[seek < 0] = 1, 0  # no score
        hit = np.zeros(other.shape, dtype=bool)
        for w in range(many):
            lo, hi = bottom[:, [w]], top[:, [w]]
            allowed = other & (most >= lo) & (least <= hi) & (lo <= hi)
            hit |= allowed & (most >= _kth(least, allowed & (least >= lo) & (most <= hi), count))
        i, j = np.nonzero(hit)
        score = _scored(a, v, i + s, j)
        for w in range(many):
            fit = np.flatnonzero((score >= bottom[i, w]) & (score <= top[i, w]))
            fit = fit[_best(i[fit], score[fit], v.id[j[fit]], count)]
            yield i[fit] + s, seek[i[fit], w], j[fit], score[fit]


def _blocks(anchors: DataFrame, rows: DataFrame, groups: int, slots: int, schema: str, work) -> DataFrame:
    """``work(anchors, rows, the anchors' table)`` on every (slot, group), by length."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for dim in np.unique(left.column("dim").to_numpy()):
            of = lambda t: t.filter(pa.compute.equal(t.column("dim"), int(dim)))
            a, v = of(left), of(right)
            if v.num_rows:
                out += work(Side(a, dim), Side(v, dim), a)
        names = [x.split()[0] for x in schema.split(", ")]
        columns = zip(*out) if out else [[] for _ in names]
        return pa.table({n: pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for n, c in zip(names, columns)})

    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("group", deal(groups)).withColumn("slot", every(slots))
    v = rows.withColumn("slot", deal(slots)).withColumn("group", every(groups))
    return a.groupBy("slot", "group").cogroup(v.groupBy("slot", "group")).applyInArrow(
        lambda left, right: run(left, right), schema)


def mine(rows: DataFrame, anchor: Column, spark: SparkSession, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` are (id, label, q) as ``quantised`` gives them, ``anchor`` tells which of them
    are anchors. Positives are the ``positives`` rows of the anchor's label that score
    highest with it, negatives of a positive the first ``negatives`` rows of other labels
    with 100 * negative score between ``low`` and ``high`` times the positive's.
    """
    scratch = Scratch(spark, "negatives")
    table = scratch.table(index(rows.withColumn("row", F.monotonically_increasing_id())), "index")
    anchors = scratch.table(table.where(anchor), "anchors")
    size = F.sum(F.length("vector") + F.length("code") + 100)
    all_, some = (t.agg(size).first()[0] or 0 for t in (table, anchors))
    groups = max(1, -(-some // GROUP_BYTES))
    slots = max(1, -(-all_ // SLOT_BYTES), min(-(-2 * spark.sparkContext.defaultParallelism // groups), all_ >> 18))

    def near(a: Side, v: Side, _: pa.Table):
        for i, j, score in positives_in(a, v, positives):
            yield a.row[i], a.id[i], v.id[j], score

    found = _blocks(anchors, table, groups, slots, "row long, anchor_id long, positive_id long, positive_score long", near)
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    best = scratch.table(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
    wanted = best.where("positive_score >= 0").groupBy("row").agg(F.collect_set("positive_score").alias("wanted"))  # a few each

    def hard(a: Side, v: Side, table_: pa.Table):
        for i, seek, j, score in negatives_in(a, v, table_.column("wanted").to_pylist(), negatives, low, high):
            yield a.row[i], seek, v.id[j], score

    met = _blocks(anchors.join(wanted, "row"), table, groups, slots,
                  "row long, positive_score long, negative_id long, negative_score long", hard)
    order = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    kept = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return best.join(kept, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
