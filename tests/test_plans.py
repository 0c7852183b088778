"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
# These run jobs while they are built (sinks, streams, models).
EAGER = ("src_", "snk_", "state_running", "state_word", "stream_", "wm_", "late_", "clf_", "reg_",
         "clu_kmeans", "rec_", "fpm_", "tune_", "model_", "feat_", "log_", "route_", "eval_binary")
LAZY = [n for n in sorted(QUERIES) if not n.startswith(EAGER) and not n.endswith("_stream")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_joins(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["rowkey_range_scan"](spark, sf_dir))
    assert "GreaterThanOrEqual(o_orderkey,1000)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text
    text = plan(QUERIES["project_cells"](spark, sf_dir))
    assert "EqualTo(event_type,signup)" in text and "props" not in text


def test_range_predicate_is_pushed_below_the_join(spark, sf_dir):
    text = plan(QUERIES["join_theta_pushdown"](spark, sf_dir))
    assert "GreaterThan(l_quantity,45.0)" in text
    # The key bound is inferred for the other side too.
    assert "GreaterThan(o_orderkey,100)" in text and "GreaterThan(l_orderkey,100)" in text


@pytest.mark.parametrize(
    "name", ["topk_per_group", "state_rate_limit_blacklist", "topn_items_per_window"]
)
def test_rank_bounds_are_applied_before_the_shuffle(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_partition_slice_prunes(spark, sf_dir):
    text = plan(QUERIES["src_partitioned_files"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 20240115", text)


@pytest.mark.parametrize("name", ["agg_word_count", "win_sliding_pv", "agg_new_users_dims"])
def test_aggregates_combine_before_the_shuffle(name, spark, sf_dir):
    assert "partial_count" in plan(QUERIES[name](spark, sf_dir))
