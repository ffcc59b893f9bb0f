"""Parity-sketch join against brute force over all pairs."""

import random

import numpy as np
import pytest
from llm.helpers import ODD, docs, shingles

from eddy.llm import parity_join as J


def _brute(rows):
    sets = {}
    for i, t, _ in rows:
        if i is not None:
            sets[i] = shingles(t)
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            s, t = sets[a], sets[b]
            if a < b and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def _corpus(seed):
    """Chains of edits around the threshold, exact copies, a passage that all share."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(r.choice(vocabulary) for _ in range(30))
    rows, n = [], 0
    for size in (1, 3, 5, 7, 9, 20, 60, 150, 300):
        base = [r.choice(vocabulary) for _ in range(size)]
        for k in range(7):
            text = list(base)
            for _ in range(max(1, size * k // 60)):
                text[r.randrange(size)] = r.choice(vocabulary)
            rows.append((n, " ".join(text) + (" " + passage if k == 6 else ""), "s"))
            n += r.choice((1, 3))
            if k == 3:
                rows.append((n, "  ".join(w.upper() for w in text), "s"))
                n += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = _corpus(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.classes(docs(spark, rows), spark).collect()}
    assert got == _brute(rows)


def test_odd_rows_and_keep_one(spark):
    long = " ".join(f"v{i}" for i in range(300))
    rows = ODD + [(20, long, "a"), (21, long + " end", "b"), (22, long, "b")]
    d = docs(spark, rows)
    got = J.classes(d, spark).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[None] == (3, None) and by[1] == (0, 1) and by[3] == (0, 3) and by[6] == (1, 6)
    assert by[21][1] == by[22][1] == 20
    kept = J.keep_one(d, spark)
    assert kept.columns == d.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 20]
    assert J.classes(d.limit(0), spark).count() == 0 and J.keep_one(d.limit(0), spark).count() == 0


def test_links_between_classes(spark):
    rows = _corpus(3)
    join = J.Join(docs(spark, rows), spark)
    got = {(r.a, r.b) for r in join.pairs().collect()}
    reps = {r.rep for r in join.reps.collect()}
    sets = {i: shingles(t) for i, t, _ in rows}
    assert got == {(a, b) for a in reps for b in reps if a < b and sets[a] and sets[b]
                   and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}


def test_sketch_words_share_what_the_bounds_promise():
    """For linked sets of every size the words exchanged agree at least as often as the
    bounds of both say, in the band of the larger set."""
    rng, layout = np.random.default_rng(5), J.Layout(75)
    for n in [1, 2, 3, 5, 7, 8, 15, 16, 17, 63, 64, 100, 129, 500]:
        for _ in range(20):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 4, dtype=np.uint64))
            a = pool[:n]
            drop, add = rng.integers(0, n // 4 + 1), rng.integers(0, n // 3 + 1)
            b = np.sort(np.concatenate([a[drop:], pool[n:n + add]]))
            if not len(b) or 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
                continue
            x, y = dict(J.sketch_words(a, layout)), dict(J.sketch_words(b, layout))
            band = max(len(a), len(b)).bit_length() - 1
            assert len(np.intersect1d(x[band], y[band])) >= max(layout.bound(len(a)), layout.bound(len(b)))


def _one_word(spark, n):
    """A join and rows of one word that ``n`` documents of their own components share."""
    rows = [(i, f"alpha beta gamma own{i // 2 * 2} " + " ".join(f"{w}{i // 2}" for w in range(8 + i % 90)), "s") for i in range(n)]
    d = docs(spark, rows)
    join = J.Join(d, spark)
    join.texts = d.select(d.doc_id.alias("doc"), "text")
    return join, spark.createDataFrame([(7, i, i) for i in range(n)], "word long, doc long, comp long"), rows


def test_last_pairs_when_a_flush_ends_a_word(spark):
    join, words, _ = _one_word(spark, 1449)  # 1,049,076 pairs: the last block passes 1 << 20
    assert join._open_pairs(words).count() >= 0


def test_frequent_words_are_cut_into_bounded_blocks(spark, monkeypatch):
    join, words, rows = _one_word(spark, 300)
    n = {i: len(shingles(t)) for i, t, _ in rows}
    sized = words.join(spark.createDataFrame(list(n.items()), "doc long, n long"), "doc")
    met, held = {}, {}
    for r in join._paired(sized, "word", 20, 1 << 62).collect():
        held.setdefault(r.pair, []).append(r)
    for group in held.values():
        assert len(group) <= 3 * 20
        for a in group:
            for b in group:
                if a.doc < b.doc and (a.alone or a.side != b.side):
                    met[a.doc, b.doc] = met.get((a.doc, b.doc), 0) + 1
    assert set(met.values()) == {1}
    assert all((a, b) in met for a in n for b in n if a < b and 100 * min(n[a], n[b]) >= 75 * max(n[a], n[b]))
    want = {(r.a, r.b) for r in join._links(join._open_pairs(words)).collect()}
    monkeypatch.setattr(J, "OPEN_BLOCK", 20)
    got = {(r.a, r.b) for r in join._links(join._open_pairs(words)).collect()}
    assert got == want and len(got) > 50


@pytest.mark.parametrize("block", [1024, 3])
def test_number_of_links(spark, monkeypatch, block):
    monkeypatch.setattr(J, "LINK_BLOCK", block)
    rows = _corpus(4)
    sets = {i: shingles(t) for i, t, _ in rows}
    want = {a: sum(a != b and bool(s) and 100 * len(s & t) >= 75 * len(s | t) for b, t in sets.items()) for a, s in sets.items()}
    got = {r.doc_id: r.n_links for r in J.classes(docs(spark, rows), spark).collect()}
    assert got == want and max(want.values()) > 2


def test_verdicts_are_per_text_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, a, "s"), (2, a + " x", "s"), (2, b, "s"), (3, c, "s"), (3, b + " y", "s"), (3, b + " y", "t"), (4, "", "s"),
            (4, b, "s"), (None, a, "s")]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    kept = sorted((r.doc_id or 0, r.text) for r in J.keep_one(docs(spark, rows), spark).collect())
    assert kept == [(0, a), (1, a), (2, b), (3, c), (4, "")]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.n_links or 0) for r in J.classes(docs(spark, rows), spark).collect())
    assert got == [(0, 36, 0, 0), (1, 36, 1, 1), (2, 36, 2, 2), (2, 37, 1, 1), (3, 36, 3, 0), (3, 37, 2, 2), (3, 37, 2, 2),
                   (4, 0, 4, 0), (4, 36, 2, 2)]


@pytest.mark.parametrize("seed", [5, 6])
def test_repeated_ids_equal_brute_force_over_texts(spark, seed):
    """Every id stands for several texts: components, links and what stays, text by text."""
    rows = [(i % 23, t, s) for i, t, s in _corpus(seed)]
    nodes = sorted({(i, frozenset(shingles(t))) for i, t, _ in rows}, key=lambda x: (x[0], sorted(x[1])))
    link = [[100 * len(s & t) >= 75 * len(s | t) for _, t in nodes] for _, s in nodes]
    comp = list(range(len(nodes)))
    for _ in nodes:
        comp = [min(comp[k] for k in range(len(nodes)) if link[j][k]) for j in range(len(nodes))]
    want = {n: (nodes[comp[j]][0], sum(link[j]) - 1) for j, n in enumerate(nodes)}
    d = docs(spark, rows).dropDuplicates(["doc_id", "text"])
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in J.classes(d, spark).collect())
    assert got == sorted((i, len(shingles(t)), *want[i, frozenset(shingles(t))]) for i, t in {(i, t) for i, t, _ in rows})
    kept = [(r.doc_id, frozenset(shingles(r.text))) for r in J.keep_one(d, spark).collect()]
    assert sorted(comp[nodes.index(k)] for k in kept) == sorted(set(comp))
    assert all(i == want[i, s][0] for i, s in kept)


def test_last_pairs_are_dealt_by_the_pairs_they_make(spark, monkeypatch):
    """Few rows that make many pairs go to several tasks, and the labels stay the same."""
    monkeypatch.setattr(J, "ROUNDS", 0)
    monkeypatch.setattr(J, "OPEN_MEETS", 64, raising=False)
    rows, tables = _corpus(3), {}
    join = J.Join(docs(spark, rows), spark)
    keep = join.scratch.table

    def table(df, name):
        tables[name] = keep(df, name)
        return tables[name]

    join.scratch.table = table
    got = {r.id: (r.n, r.component_id) for r in join.labels().collect()}
    assert got == _brute(rows)
    assert tables["bits"].select("bucket").distinct().count() > 1


def test_counting_links_of_few_sets_takes_little_memory():
    import tracemalloc

    one = np.arange(40, dtype=np.uint64)
    rows = [(0, True, 7, 1, one), (0, True, 8, 3, one + np.uint64(2)), (0, True, 9, 1, one + np.uint64(30))]
    tracemalloc.start()
    assert J._counted(rows, 75) == [(7, 3), (8, 1)]
    assert tracemalloc.get_traced_memory()[1] < 1 << 20
    tracemalloc.stop()
