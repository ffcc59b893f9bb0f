"""Toxicity, quality rules and the language model: brute-force counts, held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm.helpers import ODD, docs, lower, words
from pyspark.sql import functions as F

from eddy.llm import quality_rules, recurrent_lm, textkernel, toxicity

SF = "/root/testdata/sf0.1"


def _tables(spark, keep):
    """Labelled documents of two parts: to fit on and to hold out."""
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return d, lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == keep)


def test_toxicity_on_held_out_rows(spark):
    d, fit_on = _tables(spark, 0)
    model = toxicity.fit(d, fit_on)
    _, held = _tables(spark, 1)
    r = toxicity.judge(d, model).join(held.withColumnRenamed("toxic", "y"), "doc_id").select("y", "toxic", "severity").toPandas()
    caught, lost = r[r.y == 1].toxic.mean(), r[r.y == 0].toxic.mean()
    assert caught > 0.85 and lost < 0.01  # a few labels of rows without any toxic word are noise
    assert r[r.y == 1].severity.mean() > 10 * r[r.y == 0].severity.mean()
    assert (np.diff(model.thresholds) > 0).all()


def test_quality_rules_counts_and_held_out_rows(spark):
    d, fit_on = _tables(spark, 0)
    forest = quality_rules.fit(d, fit_on)
    _, held = _tables(spark, 1)
    r = quality_rules.judge(d, forest).join(held, "doc_id").toPandas()
    assert r[(r.quality == 1) & ~r.base_failed].kept.mean() > 0.99 and r[r.quality == 0].kept.mean() < 0.05
    text = {x.doc_id: x.text for x in d.collect()}
    for x in r.sample(400, random_state=1).itertuples():
        t = text[x.doc_id]
        w = words(t)
        lines = [s for s in t.split("\n") if words(s)]
        runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        hit = {i + j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(5)}
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))


def test_odd_rows_and_empty_tables(spark):
    d = docs(spark, ODD)
    labels = spark.createDataFrame([(4, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(d, labels) is None and quality_rules.fit(d, labels) is None
    assert toxicity.fit(d, labels.limit(0)) is None and quality_rules.fit(d.limit(0), labels) is None
    assert [r.toxic for r in toxicity.judge(d, None).collect()] == [False] * len(ODD)
    rules = {r.doc_id: r for r in quality_rules.judge(d, None).collect()}
    assert rules[1].n_words == rules[3].n_words == 0 and not rules[1].kept and rules[7].n_words == 3
    assert quality_rules.keep(d, None).columns == d.columns and quality_rules.keep(d, None).count() == 0
    assert toxicity.keep(d, None).count() == len(ODD)
    good = [(i, " ".join(f"w{j * i}" for j in range(30)), "a") for i in range(1, 40)]
    bad = [(i, "idiot moron " + " ".join(f"w{j * i}" for j in range(20)), "a") for i in range(50, 80)]
    table = docs(spark, ODD + good + bad)
    y = spark.createDataFrame([(i, 1, 0) for i, _, _ in good] + [(i, 0, 1) for i, _, _ in bad], "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, y)
    got = {r.doc_id: r.toxic for r in toxicity.judge(table, model).collect()}
    assert all(got[i] for i, _, _ in bad) and not any(got[i] for i, _, _ in good + ODD)
    assert {r.doc_id for r in toxicity.keep(table, model).collect()} == {i for i, _, _ in good + ODD}


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3)).astype(np.float32)
    z = 6 * x[:, 0] + 3 * x[:, 1] + rng.logistic(size=2000)
    grade = np.searchsorted([3.0, 5.0, 7.0], z)
    w, t = toxicity.fit_ordinal(x, grade, np.ones(2000), 3)
    assert w[0] > w[1] > w[2] and abs(w[0] - 6) < 1 and np.abs(t - [3, 5, 7]).max() < 0.8


def test_language_model_counts_and_held_out_gain(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    d = docs(spark, ODD).unionAll(d.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).cast("long").alias("id"),
                                           F.lit(1).cast("long").alias("n")).where("doc_id > 10"))
    got = recurrent_lm.scores(d, spark).collect()
    rows = [(r.doc_id, words(lower(r.text)) + ["\0end"]) for r in d.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((i or 0, held(i), len(t), sum(c[w] > 0 for w in t), round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t), 5))
                  for i, t in rows)
    assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)
    assert recurrent_lm.scores(d.limit(0), spark).count() == 0


def test_gradient_and_total_probability():
    rng = np.random.default_rng(0)
    net = recurrent_lm.Net.start(np.full(recurrent_lm.CLASSES, 1 / recurrent_lm.CLASSES),
                                 np.full((recurrent_lm.HEADS, recurrent_lm.MEMBERS), 1 / recurrent_lm.MEMBERS))
    net = recurrent_lm.Net(net.flat.astype(np.float64))
    x, cls = rng.integers(0, recurrent_lm.SYMBOLS, (5, 3)), rng.integers(0, recurrent_lm.CLASSES, (5, 3))
    cls[0] = [0, 1, 2]
    member, first, on = rng.integers(0, 16, (5, 3)), rng.random((5, 3)) < 0.3, rng.random((5, 3)) < 0.9
    h = rng.normal(0, 0.5, (3, recurrent_lm.H))
    g = recurrent_lm.gradient(net, x, first, cls, member, on, h)[0]
    for i in rng.choice(np.flatnonzero(np.abs(g) > 1e-4), 25):
        f = net.flat.copy()
        f[i] += 1e-5
        up = recurrent_lm.gradient(recurrent_lm.Net(f), x, first, cls, member, on, h)[1]
        f[i] -= 2e-5
        down = recurrent_lm.gradient(recurrent_lm.Net(f), x, first, cls, member, on, h)[1]
        assert abs((up - down) / 2e-5 - g[i]) < 2e-3 * max(1, abs(g[i]))
    every = [(c, m) for c in range(recurrent_lm.HEADS) for m in range(recurrent_lm.MEMBERS)] + [
        (c, 0) for c in range(recurrent_lm.HEADS, recurrent_lm.CLASSES)]
    p = net.log_token(np.repeat(h[:1], len(every), 0), np.array([c for c, _ in every]), np.array([m for _, m in every]),
                      np.zeros(len(every)))
    assert abs(np.exp(p).sum() - 1) < 1e-9


def _gated(net, x, h):
    """One step of a gated recurrent unit as its formula says."""
    a, b, w = net.wx[[x]] + net.un, h @ net.u, recurrent_lm.H
    z, r = (1 / (1 + np.exp(-(a + b)[:, k:k + w])) for k in (0, w))
    n = np.tanh(a[:, 2 * w:] + r * b[:, 2 * w:])
    return z * h + (1 - z) * n


def test_state_is_carried_across_windows():
    rng = np.random.default_rng(3)
    net = recurrent_lm.Net(rng.normal(0, 0.3, recurrent_lm.Net.SIZE).astype(np.float32))
    n = [70, 0, 33]
    first = np.concatenate([[0], np.cumsum(n)])
    total = first[-1]
    cls, member = rng.integers(0, recurrent_lm.CLASSES, total), rng.integers(0, 16, total)
    symbol, tail = rng.integers(0, recurrent_lm.SYMBOLS - 1, total), -rng.random(total)
    got = recurrent_lm._log_likelihood(net, first, cls, member, symbol, tail)
    for d in range(3):
        h, x, s = np.zeros((1, recurrent_lm.H), np.float32), recurrent_lm.START, 0.0
        for k in range(n[d] + 1):
            i = first[d] + k
            h = _gated(net, x, h)
            goal = (cls[i], member[i], tail[i]) if k < n[d] else (0, 0, 0.0)
            s += net.log_token(h, *[np.array([g]) for g in goal])[0]
            x = symbol[i] if k < n[d] else x
        assert abs(s - got[d]) < 1e-3


def test_scoring_takes_few_steps_whatever_the_lengths(monkeypatch):
    """Lanes go from text to text: a few long texts don't make a step for every place of
    theirs beside each block of short ones; the sums are those of texts scored alone."""
    rng = np.random.default_rng(5)
    net = recurrent_lm.Net(rng.normal(0, 0.3, recurrent_lm.Net.SIZE).astype(np.float32))
    n = np.concatenate([rng.integers(0, 90, 700), [600, 0, 512]])
    first = np.concatenate([[0], np.cumsum(n)])
    cls, member = rng.integers(0, recurrent_lm.CLASSES, first[-1]), rng.integers(0, 16, first[-1])
    symbol, tail = rng.integers(0, recurrent_lm.SYMBOLS - 1, first[-1]), -rng.random(first[-1])
    alone = [recurrent_lm._log_likelihood(net, np.array([0, b - a]), cls[a:b], member[a:b], symbol[a:b], tail[a:b])[0]
             for a, b in zip(first[:-1], first[1:])]
    steps, step = [], recurrent_lm.Cell.step
    monkeypatch.setattr(recurrent_lm.Cell, "step", lambda self, *a: (steps.append(1), step(self, *a))[1])
    got = recurrent_lm._log_likelihood(net, first, cls, member, symbol, tail)
    assert np.abs(got - alone).max() < 1e-3
    assert len(steps) <= max(n.max() + 1, (n + 1).sum() / recurrent_lm.BESIDE + 90) + recurrent_lm.WINDOW
    order, load = recurrent_lm._lanes(n + 1, 64)
    assert sorted(order) == list(range(len(n))) and load.sum() == (n + 1).sum() and (np.diff(load) <= 0).all()
    none = np.zeros(0, np.int64)
    assert len(recurrent_lm._log_likelihood(net, np.zeros(1, np.int64), none, none, none, none)) == 0


def test_shapes_of_chosen_words():
    w = textkernel.words(pa.array(["Élan vital, a1 Ünïcode! (x) 12 plain", None, "zé longerword9 naïve; ."]))
    every = recurrent_lm.shapes(w)
    of = np.array([7, 0, 3, 3, 9])
    assert recurrent_lm.shapes(w, of).tolist() == every[of].tolist() and len(set(every)) > 4
    assert len(recurrent_lm.shapes(w, of[:0])) == 0


def _random_docs(rng, sizes):
    return [(rng.integers(0, recurrent_lm.SYMBOLS, n), rng.integers(0, recurrent_lm.CLASSES, n),
             rng.integers(0, recurrent_lm.MEMBERS, n)) for n in sizes]


def test_an_update_for_about_a_thousand_tokens():
    rng = np.random.default_rng(7)
    trainer = recurrent_lm.Trainer(rng.normal(0, 0.1, recurrent_lm.Net.SIZE).astype(np.float32), 0.01)
    trainer.learn(_random_docs(rng, [200] * 400))
    assert trainer.n >= 80_000 / 1_100 and recurrent_lm.WINDOW >= 16


def test_a_short_document_of_a_task_is_learnt_from():
    rng = np.random.default_rng(9)
    start = rng.normal(0, 0.1, recurrent_lm.Net.SIZE).astype(np.float32)
    trainer = recurrent_lm.Trainer(start, 0.01)
    trainer.learn(_random_docs(rng, [30]))
    trainer.finish()
    assert trainer.tokens == 30 and trainer.held == 0 and np.abs(trainer.net.flat - start).max() > 0
    trainer.learn(_random_docs(rng, [200] * 20))
    trainer.finish()
    assert trainer.tokens == 4030


def test_every_partition_with_one_short_document_is_learnt_from(spark):
    d = spark.createDataFrame([(i, f"one two three w{i}") for i in range(24)], "doc_id long, text string").repartition(24)
    model = recurrent_lm.Model(d, spark)
    before = model.net.copy()
    model.train()
    assert np.abs(model.net - before).max() > 0


def test_partitions_and_batches_do_not_move_the_model(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    d = d.unionAll(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (-5, None), (-6, "")], d.schema))
    nets, size = [], spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n, rows in ((1, 10_000), (4, 10_000), (16, 7)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
            model = recurrent_lm.Model(d.repartition(n), spark)
            model.train()
            nets.append(model.net)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert all(np.abs(nets[0] - x).max() < 1e-5 for x in nets[1:])
    assert np.isfinite(nets[0]).all()


def test_groups_are_trained_apart_wherever_batches_end():
    rng = np.random.default_rng(4)
    rows = sorted((int(g), int(k), rng.integers(0, 288, int(n)).astype("<u2").tobytes())
                  for g, k, n in zip(rng.integers(0, 3, 40), rng.integers(0, 99, 40), rng.integers(0, 300, 40)))
    batch = pa.RecordBatch.from_pylist([{"g": g, "key": k, "codes": c} for g, k, c in rows])
    start = rng.normal(0, 0.1, recurrent_lm.Net.SIZE).astype(np.float32)
    whole = list(recurrent_lm._trained(iter([batch]), start, 0.01))
    cut = list(recurrent_lm._trained(iter([batch.slice(i, 7) for i in range(0, 40, 7)]), start, 0.01))
    assert len(whole) == len(cut) == len({g for g, _, _ in rows})
    assert all((a.net.flat == b.net.flat).all() and a.tokens == b.tokens for a, b in zip(whole, cut))
    assert sum(a.tokens for a in whole) == sum(len(c) // 2 + 1 for _, _, c in rows)
    assert list(recurrent_lm._trained(iter([]), start, 0.01)) == []
