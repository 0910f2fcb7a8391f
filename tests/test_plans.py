"""Plan shape: pruned scans, pushed filters, no pair-wise joins, partial
top-k, partial aggregation."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_pushed_to_scan(spark):
    plan = plan_of(QUERIES["P7_prefix_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(p_name), StringStartsWith(p_name,red)]" in plan


def test_column_pruning(spark):
    plan = plan_of(QUERIES["A3_anomalies_by_line"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in plan  # items are counted too
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_top_k_is_limited_per_partition(spark):
    df = QUERIES["T3_top_passages"](spark, SF_SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan


def test_latest_run_is_top_one_not_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["T1_latest_run"](spark, SF_SMALL))


def test_partial_aggregation_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(QUERIES["A2_anomaly_counts"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "partial_count" in plan
