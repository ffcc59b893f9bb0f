"""The keyed scan equals plain window functions on its plain and on its split plan, for
inputs dominated by one hot key, null keys and null values (property tests); the queries
built on it give the same rows when every key is split."""

import pytest
from conftest import SF001
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from eddy.plans.keyed import SPLIT_CONF, keyed_running
from eddy.plans.queries import QUERIES

rows = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2, None]),      # key 0 is hot, null is a key
              st.integers(min_value=0, max_value=60),        # order value
              st.one_of(st.none(), st.integers(-5, 5))),     # value (nullable)
    min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, split=st.sampled_from([None, 1, 5, 1000]))
def test_keyed_running_equals_window(spark, data, split):
    data = [(k, o, i, v) for i, (k, o, v) in enumerate(data)]
    df = spark.createDataFrame(data, "k long, o long, id long, v long")
    v = F.col("v")
    got = keyed_running(df, ["k"], ["o", "id"], {
        "cnt": ("count", None), "s": ("sum", v), "mx": ("max", v), "mn": ("min", v), "mb": ("max_before", v),
        "lst": ("last", v), "prv": ("prev", v), "nxt": ("next", v), "fst": ("first", v)}, split)
    w = Window.partitionBy("k").orderBy("o", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exp = df.select("k", "o", "id",
                    F.count(F.lit(1)).over(upto).alias("cnt"), F.sum("v").over(upto).alias("s"),
                    F.max("v").over(upto).alias("mx"), F.min("v").over(upto).alias("mn"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("mb"),
                    F.last("v", True).over(upto).alias("lst"), F.lag("v").over(w).alias("prv"),
                    F.lead("v").over(w).alias("nxt"), F.first("v", True).over(whole).alias("fst"))
    cols = ["k", "o", "id", "cnt", "s", "mx", "mn", "mb", "lst", "prv", "nxt", "fst"]
    g = sorted((tuple(r) for r in got.select(*cols).collect()), key=lambda r: r[2])
    e = sorted((tuple(r) for r in exp.select(*cols).collect()), key=lambda r: r[2])
    assert g == e and len(g) == len(data)


@pytest.mark.parametrize("key", ["q3_emit_once_last", "q3_emit_once_first", "q11_session_early", "late_rows",
                                 "check_missed_window", "state_last_changes", "word_count_running"])
def test_queries_agree_when_split(spark, key):
    plain = QUERIES[key](spark, SF001)
    before = sorted(map(repr, plain.collect()))
    spark.conf.set(SPLIT_CONF, "20")
    try:
        after = sorted(map(repr, QUERIES[key](spark, SF001).select(plain.columns).collect()))
    finally:
        spark.conf.unset(SPLIT_CONF)
    assert after == before


def test_split_bounds_rows_per_task(spark):
    """A third of the rows on one key: no range of the split plan holds much more than
    ``split_rows`` rows."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("o"))
    out = keyed_running(df, ["k"], ["o"], {"n": ("count", None)}, 100)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_kr_part" in plan
    assert out.where("k = 0").agg(F.max("n"), F.count("*")).first()[:] == (1000, 1000)
    path = next(p for p in out.inputFiles() if "-rows" in p).rsplit("/", 1)[0]
    sizes = spark.read.parquet(path).groupBy("_kr_part").count().agg(F.max("count")).first()[0]
    assert sizes <= 300
