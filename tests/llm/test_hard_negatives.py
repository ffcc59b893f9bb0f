"""Hard negatives: DuckDB twin, brute force in integers, sound intervals, odd rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from conftest import SF001
from pyspark.sql import functions as F

from eddy.llm import hard_negatives as H
from eddy.llm.queries import ORACLE, QUERIES


def plain(rows, every, positives=5, negatives=3, low=50, high=95):
    """Expected rows for (id, label, vector) rows, ids divisible by ``every`` being anchors."""
    ok = [(i, c, [math.floor(256 * float(x)) for x in v]) for i, c, v in rows
          if None not in (i, c, v) and all(x is not None and math.isfinite(x) for x in v)]
    ok = [r for r in ok if sum(x * x for x in r[2]) < 1 << 56]
    out = []
    for i, c, v in ok:
        if i % every:
            continue
        near = [(-sum(a * b for a, b in zip(v, w)), j, d) for j, d, w in ok if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in near if x[2] == c)[:positives]:
            fit = sorted((t, k) for t, k, d in near if d != c and low * -s <= 100 * -t <= high * -s)
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<float>, id int, q int")
    q = H.quantised(df, F.col("vec_id"), F.col("label"), F.col("embedding"))
    got = H.mine(q, F.col("id") % every == 0, spark, **more)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def cloud(n, dim, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) + rng.normal(size=(7, dim))[rng.integers(0, 7, n)]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    return [(i, int(rng.integers(0, labels)), v.tolist()) for i, v in enumerate(x)]


def side(vectors, labels=None):
    n, dim = vectors.shape
    width = 64 * max(1, -(-dim // 64))
    codes, scales, norm, inner, rest = H.coded(vectors, H.rotation(width))
    blobs = lambda x: [r.tobytes() for r in x]
    return H.Side(pa.table({
        "row": range(n), "id": range(n), "label": labels if labels is not None else [0] * n, "vector": blobs(vectors.astype(np.int32)),
        "code": blobs(np.ascontiguousarray(codes.transpose(1, 0, 2))), "scales": blobs(scales), "norm": norm, "coded": inner,
        "rest": rest}), dim)


@pytest.mark.parametrize("dim,size", [(64, 60), (10, 3), (130, 1_000_000), (1, 5), (64, 0)])
def test_intervals_hold_every_score(dim, size):
    rng = np.random.default_rng(dim)
    v = rng.integers(-size, size + 1, (300, dim))
    v[:3] = 0
    v[3:6] = v[6]
    s = side(v)
    least, most = H.intervals(s, s, slice(0, 100))
    exact = v[:100].astype(object) @ v.T.astype(object)
    assert (least <= exact).all() and (exact <= most).all()
    if dim == 64 and size:  # the codes leave little: most pairs far from the best are ruled out
        assert np.median(most - least) < 0.3 * np.median(s.norm) ** 2


def test_filter_rules_rows_out():
    v = np.array([[math.floor(256 * x) for x in r[2]] for r in cloud(3000, 64, labels=1)])
    s = side(v)
    least, most = H.intervals(s, s, slice(0, 60))
    kept = most >= H._kth(least, np.ones(least.shape, bool), 5)
    assert kept.mean() < 0.3


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_against_brute_force(spark, dim):
    rows = cloud(400, dim, seed=dim)
    assert mined(spark, rows, 10) == plain(rows, 10) != []


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "SLOT_BYTES", 20_000)
    monkeypatch.setattr(H, "GROUP_BYTES", 5_000)
    monkeypatch.setattr(H, "TILE", 500)
    rows = cloud(400, 64)
    assert mined(spark, rows, 10, positives=3, negatives=4, low=20, high=100) == plain(rows, 10, 3, 4, 20, 100)


def test_odd_rows(spark):
    rows = cloud(120, 8) + [(None, 1, [1.0] * 8), (500, None, [1.0] * 8), (510, 1, None), (520, 1, [None] * 8),
                            (530, 1, [math.nan] + [0.0] * 7), (540, 1, [math.inf] + [0.0] * 7), (550, 1, [1e30] * 8), (560, 1, []),
                            (570, 2, []), (580, 1, []), (590, 0, [0.0] * 8), (600, 1, [0.0] * 8), (-10, 2, [0.5] * 8), (610, 1, [1.0, 2.0]),
                            (620, 1, [2.0, 2.0]), (630, 0, [1.0, 1.0])]
    rows += [(700 + i, i % 2, [0.3] * 8) for i in range(60)]  # one vector that many rows share
    rows += [(800, 3, [0.25] * 8)] * 3  # repeated rows
    assert mined(spark, rows, 10) == plain(rows, 10)
    assert mined(spark, [], 10) == []


def test_query_against_duckdb(spark):
    r = compare(QUERIES["op11_hard_negatives"](spark, SF001), duck(SF001), ORACLE["op11_hard_negatives"])
    assert r["match"] and r["rows"][0] > 0, (r["rows"], r["diff"])
