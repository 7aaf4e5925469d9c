"""Plan shape: what reaches the scan, where the shuffles are, which nodes run."""

from urbanlens.plans.catalog import QUERIES
from urbanlens.plans.inspect import physical_plan

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return physical_plan(QUERIES[name](spark, SF))


def test_share_filter_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "time_of_day_share")
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "partial_count" in plan  # counted in every task before the shuffle


def test_total_reuses_the_counts_shuffle(spark):
    """The denominator's subquery scans nothing of its own and gathers no groups in one task."""
    for name in ("time_of_day_share", "time_of_day_share_two_sources"):
        df = QUERIES[name](spark, SF)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in final and "Window" not in final


def test_udf_variant_runs_vectorized(spark):
    plan = _plan(spark, "time_of_day_share_udf")
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_two_sources_push_the_filter_into_both_scans(spark):
    plan = _plan(spark, "time_of_day_share_two_sources")
    # Once for the groups and once, in the plan before it runs, for their total.
    assert plan.count("EqualTo(event_type,error)") == 4
    # The split of one table into two sources is pushed too (row-group pruning).
    assert "LessThan(ts,2024-01-16T00:00)" in plan
    assert "Or(GreaterThanOrEqual(ts,2024-01-16T00:00),IsNull(ts))" in plan


def test_rank_filter_becomes_a_group_limit(spark):
    assert "WindowGroupLimit" in _plan(spark, "monthly_top3_rank")
    assert "WindowGroupLimit" in _plan(spark, "monthly_top3_row_number")


def test_area_ratio_aggregates_before_the_join(spark):
    plan = _plan(spark, "area_ratio")
    agg = plan.index("partial_sum")
    assert agg < plan.rindex("Join") or "BroadcastHashJoin" in plan


def test_nearest_site_array_plan_never_shuffles_points(spark):
    plan = _plan(spark, "nearest_site_assign")
    assert "ArrowEvalPython" in plan
    assert "Exchange" not in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_no_cartesian_product_anywhere_in_the_catalogue(spark):
    for name in ("area_ratio", "area_ratio_broadcast", "area_ratio_merge", "area_ratio_shuffle_hash",
                 "area_ratio_strict", "nearest_site_assign", "nearest_site_summary"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
