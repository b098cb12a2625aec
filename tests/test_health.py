from __future__ import annotations

from datetime import timedelta

import pytest
from telemetry import AS_OF, by, event, events

from fleetgauge.operators.health import CHECKS, health_checks, health_report, last_ingested
from fleetgauge.operators.incidents import checks_to_incidents, escalations
from fleetgauge.sources.events import as_stored


def run(spark, tenants, rows, **options):
    return by(
        [r for r in health_checks(events(spark, rows), tenants, AS_OF, **options).collect()
         if r.tenant_id == "client_demo"],
        "check_name",
    )


def jobs(n, bad=0, **changes):
    return [event(f"{i}", status="FAILED" if i < bad else "SUCCEEDED", **changes) for i in range(n)]


def test_no_events_at_all(spark, tenants):
    checks = health_checks(events(spark, []), tenants, AS_OF)
    rows = checks.collect()
    assert len(rows) == 3 * len(CHECKS)
    demo = by([r for r in rows if r.tenant_id == "client_demo"], "check_name")
    stale = demo["pipeline_staleness"]
    assert (stale.passed, stale.severity, stale.metric, stale.threshold) == (False, "HIGH", None, None)
    for name in ("success_rate_1h", "success_rate_24h", "p95_latency", "gpu_cost_efficiency"):
        assert (demo[name].passed, demo[name].severity, demo[name].metric) == (True, "LOW", None)
    assert demo["daily_budget"].passed and demo["daily_budget"].metric == 0.0


@pytest.mark.parametrize("bad, passed, severity", [(3, True, "MEDIUM"), (4, False, "MEDIUM"), (6, False, "MEDIUM"), (7, False, "HIGH")])
def test_success_rate_1h_edges(spark, tenants, bad, passed, severity):
    check = run(spark, tenants, jobs(20, bad))["success_rate_1h"]
    assert (check.passed, check.severity, check.metric) == (passed, severity, 100.0 - 5 * bad)
    assert check.message.endswith(f"({20 - bad}/20 jobs)") and bool(check.action) != passed


@pytest.mark.parametrize("bad, passed", [(1, True), (2, True), (3, False)])
def test_success_rate_24h_edges(spark, tenants, bad, passed):
    check = run(spark, tenants, jobs(20, bad, minutes_ago=600))["success_rate_24h"]
    assert (check.passed, check.severity) == (passed, "MEDIUM")


def test_event_exactly_one_hour_old_is_outside(spark, tenants):
    checks = run(spark, tenants, [event(1, minutes_ago=60), event(2, minutes_ago=59.99, status="FAILED")])
    assert checks["success_rate_1h"].metric == 0.0 and checks["success_rate_24h"].metric == 50.0


@pytest.mark.parametrize("seconds, passed, severity", [(10800, True, "MEDIUM"), (10801, False, "MEDIUM"), (16200, False, "MEDIUM"), (16201, False, "HIGH")])
def test_p95_edges(spark, tenants, seconds, passed, severity):
    rows = [event(1, duration_seconds=seconds), event(2, duration_seconds=99999, status="RUNNING")]
    check = run(spark, tenants, rows)["p95_latency"]
    assert (check.passed, check.severity, check.metric) == (passed, severity, float(seconds))


@pytest.mark.parametrize("share, passed, severity", [(1.0, True, "MEDIUM"), (1.2, True, "MEDIUM"), (1.21, False, "HIGH"), (1.51, False, "CRITICAL")])
def test_daily_budget_edges(spark, tenants, share, passed, severity):
    spend = round(2500.0 / 7 * share, 6) if share != 1.2 else 428.571428
    check = run(spark, tenants, [event(1, cost_usd=spend), event(2, minutes_ago=1441, cost_usd=9e4)])["daily_budget"]
    assert (check.passed, check.severity) == (passed, severity)
    assert check.threshold == 428.5714


@pytest.mark.parametrize("minutes, passed, severity", [(30, True, "MEDIUM"), (31, False, "MEDIUM"), (60, False, "MEDIUM"), (61, False, "HIGH")])
def test_staleness_edges(spark, tenants, minutes, passed, severity):
    rows = [event(1, ingested_at=AS_OF - timedelta(minutes=minutes))]
    check = run(spark, tenants, rows)["pipeline_staleness"]
    assert (check.passed, check.severity, check.metric) == (passed, severity, float(minutes))


@pytest.mark.parametrize("short, passed", [(2, True), (3, False), (4, False)])
def test_gpu_waste_edges(spark, tenants, short, passed):
    rows = [event(i, gpu_count=1, duration_seconds=299 if i < short else 300) for i in range(10)]
    check = run(spark, tenants, rows)["gpu_cost_efficiency"]
    assert (check.passed, check.metric) == (passed, 10.0 * short)


def test_single_check_equals_its_row_of_the_full_run(spark, tenants):
    ev = events(spark, jobs(20, 4) + [event("g", gpu_count=1, duration_seconds=5)])
    full = {tuple(r) for r in health_checks(ev, tenants, AS_OF).collect()}
    for name in CHECKS:
        part = health_checks(ev, tenants, AS_OF, checks=(name,)).collect()
        assert len(part) == 3 and {tuple(r) for r in part} <= full


def test_report_counts_and_incidents(spark, tenants):
    checks = health_checks(events(spark, jobs(20, 20, cost_usd=100.0)), tenants, AS_OF).cache()
    report = by(health_report(checks, AS_OF).collect(), "tenant_id")
    demo = report["client_demo"]
    assert demo.checks_total == 6 and demo.checks_passed + demo.incidents_opened == 6
    incidents = checks_to_incidents(checks, AS_OF)
    kinds = {r.incident_type for r in incidents.collect() if r.tenant_id == "client_demo"}
    assert {"SUCCESS_RATE_1H", "SUCCESS_RATE_24H", "DAILY_BUDGET"} <= kinds
    ids = {r.incident_id for r in incidents.collect()}
    again = {r.incident_id for r in checks_to_incidents(checks, AS_OF).collect()}
    assert ids == again
    urgent = escalations(incidents, AS_OF).collect()
    assert [r.incident_type for r in urgent] == ["DAILY_BUDGET"]
    assert escalations(incidents, AS_OF + timedelta(hours=1)).count() == 0
    checks.unpersist()


def test_stored_layout_gives_the_same_checks_with_pruned_scans(spark, tenants, tmp_path):
    rows = (
        jobs(10, 2)
        + [event(f"late{i}", minutes_ago=60 * 24 * 5, ingested_at=AS_OF - timedelta(minutes=3)) for i in range(3)]
        + [event("old", minutes_ago=60 * 24 * 9, tenant_id="client_acme")]
    )
    ev = events(spark, rows)
    path = str(tmp_path / "job_events")
    as_stored(ev).write.partitionBy("event_date", "tenant_id").parquet(path)
    stored = spark.read.parquet(path)
    want = sorted(map(tuple, health_checks(ev, tenants, AS_OF).collect()), key=str)
    checks = health_checks(stored, tenants, AS_OF)
    assert sorted(map(tuple, checks.collect()), key=str) == want
    newest = by(last_ingested(stored, tenants, AS_OF).collect(), "tenant_id")
    assert newest["client_demo"].last_ingested_at == AS_OF - timedelta(minutes=3)
    assert newest["client_acme"].last_ingested_at.date().isoformat() == "2024-01-22"
    plan = checks._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert "dynamicpruning" in plan  # only silent tenants' older partitions are read
