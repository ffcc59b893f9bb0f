"""Plan-shape guards for the registered batch queries: JVM-side only, no all-pairs
joins, filters and column lists pushed into the parquet scans."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from eddy.plans.queries import QUERIES

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_and_no_all_pairs(spark, key):
    plan = _plan(E.queries()[key](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, (key, op)


def test_q3_filter_and_pruning_reach_scans(spark):
    plan = _plan(E.queries()["q3_join"](spark, SF001))
    assert "In(n_name, [NATION_1,NATION_2,NATION_3])" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_q8_event_type_filters_pushed(spark):
    plan = _plan(E.queries()["q8_window_join"](spark, SF001))
    assert "EqualTo(event_type,signup)" in plan and "EqualTo(event_type,purchase)" in plan


def test_panes_aggregate_before_expanding(spark):
    plan = _plan(E.queries()["q5_panes"](spark, SF001))
    # the explode (Generate) sits above the first aggregate, never on raw rows
    gen = plan.index("Generate")
    assert plan.index("HashAggregate", gen) > gen
    assert "Expand" not in plan


def test_tpch_date_filters_and_pruning_reach_lineitem_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # print whole filter lists
    try:
        plan = _plan(E.queries()["tpch_q6"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(l_shipdate," in plan and "LessThan(l_shipdate," in plan
    assert ("ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,"
            "l_shipdate:timestamp_ntz>") in plan


@pytest.mark.parametrize("key,k", [("tpch_q3", 10), ("tpch_q10", 20)])
def test_tpch_top_k_is_per_task(spark, key, k):
    plan = _plan(E.queries()[key](spark, SF001))
    assert f"TakeOrderedAndProject(limit={k}," in plan


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key,scans,shuffles", [
    ("word_count_running", 1, 1), ("tumbling_pass", 1, 1), ("tumbling_by_events", 1, 1), ("state_first", 1, 1),
    ("check_exactly_once", 2, 2), ("check_missed_window", 2, 8), ("q11_session_count", 1, 2)])
def test_scans_and_shuffles(spark, key, scans, shuffles):
    plan = _executed(QUERIES[key](spark, SF001))
    assert plan.count("FileScan parquet") <= scans, plan
    assert plan.count(" Exchange ") <= shuffles, plan


def test_hot_seller_is_split_in_join(spark):
    """A third of the auctions on one seller, broadcasts off: the join is skew-split."""
    from eddy.operators import joins as J
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")
    old = {n: spark.conf.get(n) for n in names}
    for n, v in zip(names, ("-1", "8k", "4k", "1.5")):
        spark.conf.set(n, v)
    try:
        from pyspark.sql import functions as F
        a = spark.range(60_000).repartition(8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("seller"))
        p = spark.range(5000).select("id", *[F.col("id").cast("string").alias(c) for c in ("name", "city", "state")])
        df = J.incremental_join(a, p)
        assert df.count() == 60_000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)


def test_both_sides_of_join_from_one_frame(spark):
    from pyspark.sql import functions as F
    from eddy.operators import joins as J
    both = spark.range(10).select("id", F.col("id").alias("seller"), *[F.lit("x").alias(c) for c in ("name", "city", "state")])
    assert J.incremental_join(both, both).count() == 10
