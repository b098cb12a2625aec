"""What the physical plans must look like for large tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import own_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    built = {}
    for name, query in own_queries().items():
        if name != "stream_daily":
            built[name] = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return built


def test_no_cross_joins_or_python_rows(plans):
    for name, plan in plans.items():
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert word not in plan, (name, word)


def test_scans_read_only_needed_columns(plans):
    for name, plan in plans.items():
        assert "props" not in plan.split("ReadSchema: ")[1].split("\n")[0], name


def test_time_ranges_reach_the_scan(plans):
    for name in ("daily_cost_summary", "cost_spikes", "budget_status", "failure_rates", "top_expensive_jobs"):
        assert "GreaterThan" in plans[name].split("PushedFilters: [")[1].split("]")[0], name


def test_top_k_trims_before_the_shuffle(plans):
    for name in ("top_expensive_jobs", "cost_spikes", "duration_outliers", "open_incidents_top20", "dedup_events"):
        assert "WindowGroupLimit" in plans[name], name


def test_one_scan_per_dataset(plans):
    """Every measure of a dataset comes out of the same pass over the events."""
    single = (
        "daily_cost_summary", "latency_by_framework", "weekly_gpu_spend", "daily_metrics", "health_checks",
        "health_report", "failure_rates", "gpu_waste_rates", "budget_status", "daily_spend", "dq_checks",
        "inline_incidents", "trailing_windows",
    )
    for name in single:
        unions = 2 if name == "dq_checks" else 1  # its input is itself a union of two reads
        assert plans[name].count("FileScan parquet") == unions, name


def test_dimensions_are_broadcast_by_size(spark, tenants, rates):
    from telemetry import event, events

    from fleetgauge.operators.costs import with_costs
    from fleetgauge.sources.dimensions import with_budget

    ev = events(spark, [event(1)])
    for df in (with_costs(ev, rates), with_budget(ev, tenants)):
        assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:  # too large for the threshold: a shuffled join, not a failure
        big = with_budget(ev, tenants)
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString() and big.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
