"""Mergeable user aggregates against plain Python: hot keys, nulls, many tasks, no keys."""

import pytest
from pyspark.sql import functions as F

from eddy.operators.user_aggregates import TopList, UserAggregate, aggregate_by




def _plain(rows, k):
    want = {}
    for key, value, i in rows:
        want.setdefault(key, []).extend([(-value, i)] if value is not None else [])
    return {key: ([-v for v, _ in sorted(x)[:k]], [i for _, i in sorted(x)[:k]]) for key, x in want.items()}


@pytest.mark.parametrize("tasks,fanout,most", [(1, 1, 100_000), (13, 3, 5), (13, 32, 100_000)])
def test_top_list(spark, tasks, fanout, most):
    rows = [(("hot" if i % 3 else f"k{i % 40}") if i % 7 else None, float(i * 7919 % 501) if i % 11 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, id long").repartition(tasks)
    got = aggregate_by(df, ["k"], ["v", "id"], TopList(4), fanout=fanout, most_keys=most).collect()
    assert {r["k"]: (list(r["vals"]), list(r["ids"])) for r in got} == _plain(rows, 4)
    assert len(got) == len({r[0] for r in rows})


def test_several_keys_and_no_key(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"),
                                 F.col("id").cast("double").alias("v"), "id")
    got = aggregate_by(df, ["a", "b"], ["v", "id"], TopList(1)).collect()
    assert {(r["a"], r["b"]): r["ids"][0] for r in got} == {
        (a, b): max(i for i in range(500) if i % 3 == a and (i % 2 == 0) == (b == "x")) for a in range(3) for b in ("x", None)}
    assert [r["ids"] for r in aggregate_by(df, [], ["v", "id"], TopList(3)).collect()] == [[499, 498, 497]]
    assert aggregate_by(df.limit(0), ["a"], ["v", "id"], TopList(3)).collect() == []


def test_hot_key_is_combined_before_the_shuffle(spark):
    """One accumulator per task crosses the exchange, whatever the key's number of rows."""
    class Rows(UserAggregate):
        state = "n long, sent long"
        result = "n long, sent long"

        def create(self):
            return 0, 1

        def add(self, acc, value):
            return acc[0] + 1, 1

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1]

    df = spark.range(0, 20_000, 1, 6).select(F.lit(1).alias("k"), "id")
    assert [tuple(r) for r in aggregate_by(df, ["k"], ["id"], Rows()).collect()] == [(1, 20_000, 6)]


def test_state_named_like_a_key_is_refused(spark):
    with pytest.raises(ValueError):
        aggregate_by(spark.range(3).withColumnRenamed("id", "vals"), ["vals"], ["vals", "vals"], TopList(1))
