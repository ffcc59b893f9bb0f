"""Toxicity severity by cumulative-link ordinal regression.

For grades 0 < 1 < ... < K the model is P(grade >= k) = sigmoid(w.x - t_k), with one
weight vector for all thresholds t_1 < ... < t_K. x is sparse: how dense in a text the
words and word beginnings are that have a weight (log scale).
Expected severity is the sum of P(grade >= k) over k.

Labels say toxic or not; toxic rows are graded 1 to K by how dense marker words (words
seen almost only in toxic rows) are in them, in equal parts. The model is fitted on at
most ``max_labelled`` labelled documents (a documented bound, by the order of a hash of
the id); every document is scored on its whole text.

Defined cases: a null or empty text has no features and is scored from the thresholds
alone; without labels of both kinds severity is 0 and nothing is toxic; repeated rows
are scored each; null ids are scored; in labels, rows with nulls are ignored and of
several labels of one id the largest counts; other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.llm import textkernel as K
from eddy.llm.scratch import Scratch

HEADS = (4, 5, 6, 7, 8)


def _occurrences(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(first word of each text, text of each word, hashes: words, then beginnings)."""
    w = K.words(text, gaps=K.NOT_ALNUM, heads=HEADS)
    of = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    return w.first, of, [w.hash, *w.heads.values()]


def _hits(of: np.ndarray, hashes: list[np.ndarray], keys: np.ndarray):
    """(text, index into sorted ``keys``, how often) for every key that a text holds."""
    maybe = np.zeros(1 << 16, dtype=bool)
    maybe[keys & K.U(0xFFFF)] = True
    p = max(len(keys), 1)
    found = [np.zeros(0, dtype=np.int64)]
    for h in hashes if len(keys) else []:
        hit = np.flatnonzero(maybe[h & K.U(0xFFFF)])
        i = np.minimum(np.searchsorted(keys, h[hit]), p - 1)
        same = keys[i] == h[hit]
        found.append(of[hit[same]] * p + i[same])
    pairs, times = np.unique(np.concatenate(found), return_counts=True)
    return pairs // p, pairs % p, times


@dataclass(frozen=True)
class Severity:
    keys: np.ndarray       # sorted feature hashes with a weight
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above 0
    cut: float             # P(grade >= 1) from which a document counts as toxic

    def linear(self, text: pa.Array) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(self._part(text.slice(a, b - a)) for a, b in K.parts(text))])

    def _part(self, text: pa.Array) -> np.ndarray:
        first, of, hashes = _occurrences(text)
        out, n_words = np.zeros(len(first) - 1), np.diff(first)
        if not len(self.keys):
            return out
        text_of, key, times = _hits(of, hashes, self.keys)
        value = self.weights[key] * _density(times, n_words[text_of])
        return out + np.bincount(text_of, weights=value, minlength=len(out))

    def at_least(self, text: pa.Array) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per text."""
        return _sigmoid(self.linear(text)[:, None] - self.thresholds[None, :])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from (b.slice(x, y - x) for x, y in K.parts(b.column(1)))


def _density(times, n_words):
    return np.log1p(100.0 * times / (n_words + 50.0))


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int, ridge: float = 1e-4,
                steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the cumulative-link likelihood.

    Row i contributes log(P(>= g_i) - P(>= g_i + 1)); thresholds are the running sum of a
    first value and positive gaps, so they stay ordered. Weights are held at 0 or above:
    features mark toxic texts only.
    """
    n, p = x.shape
    x = x.astype(np.float32)
    w = np.zeros(p, dtype=np.float32)
    raw = np.zeros(grades)  # first threshold, then log gaps
    m = [np.zeros_like(w), np.zeros(grades)]
    v = [np.zeros_like(w), np.zeros(grades)]
    share = weight / weight.sum()
    rows = np.arange(n)
    for step in range(1, steps + 1):
        t = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        z = (x @ w).astype(np.float64)
        cum = np.ones((n, grades + 2))
        cum[:, 1:-1] = _sigmoid(z[:, None] - t)
        cum[:, -1] = 0.0
        slope = cum * (1 - cum)
        prob = np.maximum(cum[rows, grade] - cum[rows, grade + 1], 1e-9)
        up, down = slope[rows, grade] / prob, slope[rows, grade + 1] / prob
        dz = -share * (up - down)
        dt = np.bincount(grade, share * up, grades + 2) - np.bincount(grade + 1, share * down, grades + 2)
        tail = np.cumsum(dt[1:-1][::-1])[::-1]
        g = [dz.astype(np.float32) @ x + ridge * w, np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])]
        for k, target in enumerate((w, raw)):
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            target -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        w[:] = np.maximum(w, 0.0)
    return w.astype(np.float64), np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", grades: int = 3, max_labelled: int = 6000, max_features: int = 300) -> Severity | None:
    """Fit on at most ``max_labelled`` labelled documents, a third of them toxic at most."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .dropna().groupBy("id").agg(F.max("y").alias("y")))
    picked = None
    for y, n in ((1, max_labelled // 3), (0, max_labelled - max_labelled // 3)):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
        picked = part if picked is None else picked.unionAll(part)
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
              .groupBy("id", "y").agg(F.min("text").alias("text")))  # one row stands for a repeated id

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            first, _, hashes = _occurrences(b.column(1))
            sets = [np.unique(np.concatenate([h[s:e] for h in hashes])) for s, e in zip(first[:-1], first[1:])]
            ends = np.cumsum([0, *(len(x) for x in sets)]).astype(np.int32)
            marks = np.array([K.mix(x).sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(marks.view(np.int64)),
                 pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))], names=["id", "y", "mark", "keys"])

    # One row for each distinct set of words: groups of copies must not weigh more.
    scratch = Scratch(docs.sparkSession, "toxicity")
    held = scratch.table(sample.select("id", "text", "y").mapInArrow(
        K.trimmed(bags), "id long, y int, mark long, keys array<long>"), "bags")
    one = held.where(F.size("keys") > 0).groupBy("y", "mark").agg(F.min("id").alias("id"))
    one = scratch.table(one.groupBy("id", "y").agg(F.min("mark").alias("mark")), "one")
    total = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    if not toxic or not clean:
        return None
    picked = _features(held.join(F.broadcast(one), ["id", "y", "mark"]), toxic, clean, max_features)
    scratch.drop(held)
    keys = np.sort(np.array([r["key"] for r in picked], dtype=np.int64).view(np.uint64))
    marker = np.array(sorted(r["key"] for r in picked if r["marker"]), dtype=np.int64).view(np.uint64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _small(batches):
            first, of, hashes = _occurrences(b.column(1))
            text, key, times = _hits(of, hashes, keys)
            x = np.zeros((b.num_rows, len(keys)), dtype=np.float32)
            x[text, key] = _density(times, np.diff(first)[text])
            hits = np.bincount(text, weights=times * np.isin(keys, marker)[key], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(hits / (np.diff(first) + 50.0)),
                 pa.array([r.tobytes() for r in x], type=pa.binary())], names=["id", "y", "dense", "x"])

    got = (sample.join(F.broadcast(one), ["id", "y"]).select("id", "text", "y")
           .mapInArrow(K.trimmed(rows), "id long, y int, dense double, x binary").toArrow())
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), dtype=np.float32).reshape(got.num_rows, len(keys))
    ids, y, dense = (got.column(k).to_numpy() for k in ("id", "y", "dense"))
    order = np.lexsort([dense, ids])
    return _fit(x[order], y[order], dense[order], keys, grades)


def _features(bags: DataFrame, toxic: int, clean: int, most: int):
    """(key, marker) of the features that carry signal: those of the largest likelihood
    ratio against "as frequent in toxic rows as in the rest", beyond what chance gives
    the best of so many."""
    seen = (bags.select("y", F.explode("keys").alias("key")).groupBy("key")
            .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")))
    a, b, n = F.col("a"), F.col("b"), toxic + clean
    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    share = (a + b) / n
    ratio = 2 * (a * F.log(a / (toxic * share)) + F.when(b > 0, b * F.log(b / (clean * share))).otherwise(0.0))
    return (seen.where(a >= 4).select("key", "a", odds.alias("odds"), ratio.alias("ratio"))
            .where((F.col("odds") > 0) & (F.col("ratio") > 30.0))
            .orderBy(F.desc("ratio"), "key").limit(most)
            .select("key", ((F.col("odds") > 3.0) & (F.col("a") >= 5)).alias("marker")).collect())


def _fit(x, y, dense, keys, grades: int) -> Severity:
    bounds = np.quantile(dense[y > 0], np.arange(1, grades) / grades)
    grade = np.where(y > 0, 1 + np.searchsorted(bounds, dense, side="left"), 0)
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())
    hold = np.arange(len(y)) % 4 == 0
    cut = 0.5
    if 0 < (y[~hold] > 0).sum() < (~hold).sum():
        w, t = fit_ordinal(x[~hold], grade[~hold], weight[~hold], grades)
        cut = _cut(_sigmoid(x[hold] @ w - t[0]), y[hold] > 0)
    w, t = fit_ordinal(x, grade, weight, grades)
    used = np.flatnonzero(w)
    return Severity(keys[used], w[used], t, cut)


def _cut(p: np.ndarray, toxic: np.ndarray) -> float:
    """The probability that separates held-out rows best; a lost clean row counts as four
    missed toxic ones. Among equals the one nearest to one half."""
    tries = np.linspace(0.05, 0.95, 91)
    cost = [(4 * (p[~toxic] >= c).mean() if (~toxic).any() else 0) + ((p[toxic] < c).mean() if toxic.any() else 0) for c in tries]
    best = np.flatnonzero(np.array(cost) <= min(cost) + 1e-12)
    return float(tries[best[np.argmin(np.abs(tries[best] - 0.5))]])


def judge(docs: DataFrame, model: Severity | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, severity (expected grade), p_toxic, grade (most likely), toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.at_least(b.column(1)) if model else np.zeros((b.num_rows, 1))
            steps = np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], axis=1)
            grade = np.argmax(steps[:, :-1] - steps[:, 1:], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(grade), pa.array(_is_toxic(p, model))],
                names=["id", "severity", "p_toxic", "grade", "toxic"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    out = picked.mapInArrow(K.trimmed(run), f"id {kind}, severity double, p_toxic double, grade int, toxic boolean")
    return out.withColumnRenamed("id", id_col)


def _is_toxic(p: np.ndarray, model: Severity | None) -> np.ndarray:
    return p[:, 0] >= model.cut if model else np.zeros(len(p), dtype=bool)


def keep(docs: DataFrame, model: Severity | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns."""
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~_is_toxic(model.at_least(b.column(at)), model)))

    return docs.mapInArrow(K.trimmed(run), docs.schema)
