"""Plan checks over every registered query: JVM-only expressions, no cartesian products,
filters and projections pushed into the Parquet scans."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE_DIR

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"]
STREAMING = {"stream_bucket_avg", "stream_upsert", "stream_scoring", "stream_distinct", "subscription_upsert", "live_scores", "stream_upsample", "live_forecast_error"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - STREAMING))
def test_plan_is_jvm_only_and_has_no_cartesian_product(spark, name):
    plan = _plan(E.queries()[name](spark, SMOKE_DIR))
    for word in FORBIDDEN:
        assert word not in plan, f"{name}: {word} in plan"


def test_flagship_prunes_columns_and_pre_aggregates(spark):
    plan = _plan(E.queries()["bucket_join_shifted"](spark, SMOKE_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in plan
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "partial_avg" in plan


def test_explore_table_uses_one_grouping_pass(spark):
    plan = _plan(E.queries()["explore_table"](spark, SMOKE_DIR))
    assert plan.count("Expand") == 1
    assert "SortMergeJoin" not in plan or plan.count("SortMergeJoin") <= 1


def test_latest_prediction_pushes_the_lookback(spark):
    plan = _plan(E.queries()["latest_prediction"](spark, SMOKE_DIR))
    assert "TakeOrderedAndProject" in plan
    assert "LessThanOrEqual(ts,ScalarSubquery" in plan


@pytest.mark.parametrize("name, key", [("utc_offset", "event_type"), ("box_stats", "mode_event_type"), ("prev_pair", "__chunk")])
def test_rows_are_not_shuffled_on_a_hot_key(spark, name, key):
    """With nothing small enough for the planner, the size-checked tables are still broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[name](spark, SMOKE_DIR)
        df.collect()
        joins = [line for line in _plan(df).split("Initial Plan")[0].splitlines() if "Join" in line]
        assert any("BroadcastHashJoin" in line for line in joins)
        assert not any("SortMergeJoin" in line and key in line for line in joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
