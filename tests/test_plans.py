"""Shape of the physical plans that matter at scale."""

import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
LAZY = ["agg1_window_stats", "agg4_device_profile", "agg5_describe", "agg9_unified_stats", "agg28_executive_summary", "agg35_histogram",
        "agg36_box_outliers", "api1_machines_status", "jn1_api6_machines_summary", "jn2_compare_devices", "ml1_linear_trend",
        "ml2_pairwise_corr", "ml13_forecast", "win3_rolling_features", "win5_zscore", "win8_ordinal", "val2_ingest_reason"]


def plan(spark, name):
    return driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hot_path_shuffles_once_and_reads_four_columns(spark):
    text = plan(spark, "agg1_window_stats")
    assert text.count("Exchange hashpartitioning") == 1 and "partial_avg" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text


def test_latest_aggregates_by_hash(spark):
    text = plan(spark, "win1_latest")
    assert "SortAggregate" not in text and "partial_max_by" in text


def test_projections_do_not_shuffle(spark):
    for name in ("val2_ingest_reason", "val6_validate_raw", "val11_reject_reason", "snk2_topic_records"):
        assert "Exchange" not in plan(spark, name)
