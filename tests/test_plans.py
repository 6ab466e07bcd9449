"""Plan-shape guards for scale: no cartesian / nested-loop joins, filters and
column pruning at the parquet scan, no window keyed only by the entity."""

import re

import pytest

import __spark_entry__ as E

BASE = "/root/testdata/sf0.001"
SUBSET = ["customer_mart", "item_popularity", "asof_join", "ts_features", "interval_label", "batch_features",
          "prop_ztest", "psi", "threshold_sweep", "user_profile", "dedup_first", "fill_group_mean", "box_stats",
          "regression_metrics", "global_stats", "describe_numeric", "ts_lags", "lag_gap_days", "credit_observations", "booking_table",
          "knn_regression", "alpha_grid", "fold_ranking_scores", "stratified_split_rows", "resample_rows", "visitor_features",
          "class_weights", "target_encoding", "tfidf_features", "kpi_sheet", "group_activity"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SUBSET)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, BASE))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _window_partitions(plan: str) -> list[list[str]]:
    """Partition columns of each Window node; a window over the per-(key,
    partition) summary (ordered by _pid, <= #partitions rows per key) is
    bounded by construction and reported with a '_pid' marker."""
    out = []
    for part, order in re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan):
        cols = [re.sub(r"#\d+L?", "", c).strip() for c in part.split(",") if c.strip()]
        if "_pid" in order:
            cols.append("_pid")
        out.append(cols)
    return out


def test_ordered_scan_windows_are_bounded_by_partition(spark):
    from pyspark.sql import functions as F
    from tessera.operators.ordered import with_rank
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    plan = _plan(with_rank(ev, ["user_id"], [F.col("ts"), F.col("event_id")], sums=["value"]))
    parts = _window_partitions(plan)
    assert parts, "expected the local running-sum window"
    for cols in parts:
        assert "_pid" in cols, f"window partitioned by {cols} (a whole key in one task)"


@pytest.mark.parametrize("name", ["dedup_first", "fill_group_mean", "group_share", "user_profile"])
def test_no_entity_window_in_aggregate_style_operators(spark, name):
    plan = _plan(E.queries()[name](spark, BASE))
    for cols in _window_partitions(plan):
        assert "_pid" in cols, f"{name}: window partitioned by {cols}"


def test_mart_pushes_filters_and_prunes_columns(spark):
    df = E.queries()["customer_mart"](spark, BASE)
    plan = _plan(df)
    assert "PushedFilters: [In(o_orderstatus, [F,P])" in plan or "In(o_orderstatus" in plan
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all(s.count(":") <= 4 for s in scans)   # no full-width table scans


@pytest.mark.parametrize("name", ["ts_lags", "ts_rolling_mean", "lag_gap_days", "asof_join", "lagged_label"])
def test_looking_back_joins_no_rows(spark, name):
    """What is before a row comes from a window and carried rows, not from a join of the rows with themselves."""
    plan = _plan(E.queries()[name](spark, BASE))
    for windows in _window_partitions(plan):
        assert "_pid" in windows, windows
    assert plan.count("SortMergeJoin") == 0
