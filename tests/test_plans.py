"""The physical plans are the ones designed for scale (pushdown, pruning,
partial aggregation, pre-shuffle group limits, no whole-session tasks)."""

import pytest

import __spark_entry__ as E

from paths import SF001


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_and_pushes(spark):
    p = plan(spark, "visits_date_range")
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in p and "LessThanOrEqual(ts,2024-01-20T23:59:59)" in p
    p = plan(spark, "top10_categories")
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in p
    assert "TakeOrderedAndProject" in p
    assert "partial_count" in p


def test_top_sessions_limits_before_shuffle(spark):
    p = plan(spark, "top10_sessions_per_category")
    assert p.count("WindowGroupLimit") == 2        # partial (map side) and final
    assert "BroadcastExchange" in p                # top list: at most n rows
    assert "partial_count" in p


def test_ban_ranks_only_keys_that_reach_the_threshold(spark):
    p = plan(spark, "banned_users_per_event")
    assert p.count("WindowGroupLimit") == 2 and "LeftSemi" in p
    p = plan(spark, "banned_users")
    assert "partial_count" in p and "WindowGroupLimit" not in p      # counts per batch, no raw clicks ranked


def test_group_limit_holds_for_large_n(spark):
    from clicklens.operators.topk import nth_per_group
    events = spark.read.parquet(f"{SF001}/events.parquet")
    df = nth_per_group(events.select("user_id", "event_id"), ["user_id"], ["event_id"], 1001)
    assert df._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["clicks_accepted_per_batch", "clicks_accepted_per_event"])
def test_clicks_are_not_shuffled_for_few_bans(spark, name):
    p = plan(spark, name)
    # The bans are aggregated by shuffle; the clicks that they are joined to are not.
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "hashpartitioning" not in p.split("BroadcastExchange")[0]


def test_conversion_shuffles_the_visits_once(spark):
    p = plan(spark, "page_conversion_rate")
    assert p.count("hashpartitioning(session_id#") == 1 and p.count("Window") == 1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["trend_sliding", "daily_ad_totals", "top3_ads_per_area"])
def test_ads_partial_aggregation(spark, name):
    p = plan(spark, name)
    assert "partial_count" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p   # no Python UDF


def test_no_python_udfs_anywhere(spark):
    from clicklens import registry
    for name in registry.queries():
        if name.endswith("_stream") or name.endswith("roundtrip") or name in ("late_clicks", "quarantined_lines"):
            continue
        p = plan(spark, name)
        assert "EvalPython" not in p, name
