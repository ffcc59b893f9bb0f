"""Resampling by importance weights: DuckDB twin, brute force in plain Python, odd inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from compare import compare, duck
from conftest import SF001
from llm.helpers import ODD, docs, lower

from eddy.llm import resampling as R
from eddy.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(lower(text))
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(f):
    return zlib.crc32(f.encode()) % 10000


def plain(rows, target, percent, least):
    """Expected (id, n_features, weight, score, rank) multiset."""
    s = Counter(bucket(f) for _, t in rows for f in features(t))
    t = Counter(bucket(f) for x in target for f in features(x))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for i, text in rows:
        f = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[bucket(x)] for x in f)
        out.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))),
                    len(WORD.findall(lower(text)))])
    drawn = sorted((x for x in out if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    rank = {}
    for k, x in enumerate(drawn[:percent * len(drawn) // 100], 1):
        rank[id(x)] = k
    return sorted(((*x[:4], rank.get(id(x))) for x in out), key=str)


TEXTS = ["a b\nc\n\nd e f", "a b\nc", "one\ntwo\nthree\nfour", "same line\nsame line\nsame line", "\n\n\n", "X-y_z 9é　ü 🎉\nq",
         "y" * 300 + " " + "z" * 64 + " " + "w" * 63 + "\n" + "v" * 65, " ".join(f"w{i % 17}" for i in range(400)),
         "\n".join(f"k{i % 5}" for i in range(90)), "\x00\x01nul\x7fdel a\tb\r\nc"]


def test_kernel_splits_runs_into_lines_and_crossings():
    texts = [*TEXTS, None, ""]
    whole, cross = R.runs(pa.array(texts), False), R.runs(pa.array(texts), True)
    for d, text in enumerate(texts):
        of = lambda r: Counter(r.bucket[r.first[d]:r.first[d + 1]].tolist())
        assert of(whole) == Counter(map(bucket, features(text)))
        assert of(cross) + Counter(bucket(f) for line in (text or "").split("\n") for f in features(line)) == of(whole)


def test_against_brute_force_with_odd_rows(spark):
    rows = [(i, t) for i, t, _ in ODD] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, TEXTS[1])] * 3
    rows += [(500 + i % 60, " ".join(f"t{i * j % 23}" for j in range(25)) + "\nshared line of many") for i in range(90)]
    target = ["shared line of one\nt1 t2 t3", None, ""]
    df = docs(spark, [(i, t, "s") for i, t in rows])
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, weight int")
    for percent, least in ((5, 20), (100, 0)):
        got = R.resample(df, bench, spark, percent=percent, least=least)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows, target, percent, least)


def test_empty_tables(spark):
    none = docs(spark, [])
    one = spark.createDataFrame([("x y",)], "text string")
    assert R.resample(none, one, spark).collect() == []
    got = R.resample(docs(spark, [(1, "a b", "s")]), one.limit(0), spark).collect()
    assert [(r["n_features"], r["rank"]) for r in got] == [(3, None)]


@pytest.mark.parametrize("sf", [SF001])
def test_query_against_duckdb(spark, sf):
    r = compare(QUERIES["op12_resampling"](spark, sf), duck(sf), ORACLE["op12_resampling"])
    assert r["match"], (r["rows"], r["diff"])
