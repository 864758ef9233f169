"""The physical plans: what reaches the scan, what is shuffled, what is never used."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from issuelens.plans.queries import QUERIES
from issuelens.sources import relational


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "stats_overall", "stats_by_category", "stats_by_creator", "stats_by_week", "weekly_series", "base_clean", "dedup_first",
    "category_stats", "top_videos", "creator_rank", "corr_matrix", "describe_metrics", "duration_stats", "yearly_trend",
    "histogram_view", "category_share", "top_n_other", "zscore_metrics", "null_profile", "range_match_issue", "dwd_fact",
    "type1_dimension", "dws_creator", "dws_category", "dws_weekly", "ads_hot_videos", "ads_weekly_kpi", "weeks_list",
    "video_page", "video_detail", "creators_page", "categories_list", "load_upsert_last_wins", "reconcile_keys", "tokens",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text


def test_first_rows_are_limited_before_the_shuffle(spark, data):
    text = plan(relational.first_appearances(spark, data, ["aid", "view"]))
    assert "row_number(), 1, Partial" in text
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")


def test_weekly_statistics_read_line_items_only(spark, data):
    text = plan(QUERIES["weekly_series"](spark, data))
    assert text.count("FileScan parquet") == 1 and "p_name" not in text and "Join" not in text


def test_filter_and_columns_reach_the_scan(spark, data):
    text = plan(QUERIES["scan_parquet"](spark, data))
    assert "GreaterThanOrEqual(l_quantity,49.0)" in text
    assert "ReadSchema: struct<l_quantity:double,l_linestatus:string>" in text


def test_point_lookup_reaches_the_scan(spark, data):
    assert "EqualTo(l_partkey,42)" in plan(QUERIES["video_detail"](spark, data))


def test_unpartitioned_windows_see_one_row_per_range(spark, data):
    """Global order operators never sort all rows in one task."""
    text = plan(QUERIES["running_best"](spark, data))
    single = text[: text.index("SinglePartition")] if "SinglePartition" in text else ""
    assert "BroadcastExchange" in single


def test_entry_and_registry(spark):
    assert entry(spark).columns == ["tname", "video_count", "avg_view", "avg_like", "avg_interaction_rate"]
    assert set(oracle_sql()) <= set(queries())
    # Queries of the training-data subpackage have tests of their own.
    rows_only = {k for k in set(queries()) - set(oracle_sql()) if k in QUERIES}
    assert rows_only == {
        "kmeans_assign", "kmeans_profile", "kmeans_importance", "pca_scatter",
        "model_comparison", "param_search", "model_importance", "residuals",
    }


def test_every_line_has_its_order_part_and_supplier(spark, data):
    lines = relational.table(spark, data, "lineitem")
    for name, ours, theirs in [("orders", "l_orderkey", "o_orderkey"), ("part", "l_partkey", "p_partkey"), ("supplier", "l_suppkey", "s_suppkey")]:
        side = relational.table(spark, data, name)
        assert lines.join(side, F.col(ours) == F.col(theirs), "left_anti").count() == 0
