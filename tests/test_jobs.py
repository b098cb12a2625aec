from __future__ import annotations

from datetime import timedelta

import pytest
from telemetry import AS_OF, by, event, events

from fleetgauge import jobs
from fleetgauge.operators.quality import QualityError
from fleetgauge.sources.events import as_stored, read_table
from fleetgauge.sources.sinks import append_new, touched_slices


@pytest.fixture
def root(spark, tmp_path):
    rows = [event(i, minutes_ago=5 + i, status="FAILED" if i < 8 else "SUCCEEDED", cost_usd=100.0) for i in range(10)]
    ev = as_stored(events(spark, rows))
    append_new(spark, ev, str(tmp_path), "job_events", "event_id")
    return str(tmp_path)


def test_health_run_stores_each_incident_once(spark, tenants, root):
    first = jobs.run_health(spark, root, tenants, AS_OF).first()
    stored = read_table(spark, root, "incidents")
    assert stored.count() == first.incidents_opened + first.anomalies_flagged > 0
    assert first.tenants_checked == 3
    again = jobs.run_health(spark, root, tenants, AS_OF).first()
    assert again == first and read_table(spark, root, "incidents").count() == stored.count()
    later = jobs.run_health(spark, root, tenants, AS_OF + timedelta(hours=2)).first()
    assert read_table(spark, root, "incidents").count() == stored.count() + later.incidents_opened
    urgent = jobs.critical_incidents(spark, root, AS_OF).collect()
    assert [(r.tenant_id, r.incident_type) for r in urgent] == [("client_demo", "DAILY_BUDGET")]


def test_no_incident_table_yet(spark, root):
    assert jobs.critical_incidents(spark, root, AS_OF).count() == 0


def test_quality_gate_metrics_and_window_report(spark, tenants, root):
    slices = touched_slices(read_table(spark, root, "job_events"))
    jobs.run_quality_and_metrics(spark, root, tenants, slices, AS_OF)
    assert read_table(spark, root, "daily_metrics").first().total_jobs == 10
    report = by(read_table(spark, root, "incidents").collect(), "tenant_id")["system"]
    assert (report.severity, report.metric_value) == ("HIGH", 8.0)


def test_failed_gate_still_reports_the_window(spark, tenants, root):
    bad = as_stored(events(spark, [event("bad", cost_usd=-5.0, status="FAILED")]))
    append_new(spark, bad, root, "job_events", "event_id")
    with pytest.raises(QualityError, match="negative_cost"):
        jobs.run_quality_and_metrics(spark, root, tenants, touched_slices(bad), AS_OF)
    assert read_table(spark, root, "incidents").first().metric_value == 9.0


def test_digests_are_stored_once_per_day(spark, tenants, root):
    for _ in range(2):
        stored = jobs.run_digests(spark, root, tenants, AS_OF)
    assert stored.count() == 3
    demo = by(stored.collect(), "tenant_id")["client_demo"]
    assert demo.total_cost_usd == 1000.0 and demo.budget_status == "ON_TRACK"
    assert jobs.run_digests(spark, root, tenants, AS_OF, "WEEKLY").count() == 3
