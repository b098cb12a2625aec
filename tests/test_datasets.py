from __future__ import annotations

from datetime import date, timedelta

import pytest
from telemetry import AS_OF, by, event, events
from pyspark.sql import functions as F

from fleetgauge.operators.incidents import inline_incidents, open_incidents
from fleetgauge.plans import digest, finance, metrics, operations, reports

SINCE = AS_OF - timedelta(days=30)


@pytest.fixture(scope="module")
def ev(spark):
    rows = []
    for i in range(240):
        rows.append(event(
            i, minutes_ago=179 * i + 3,
            tenant_id=("client_demo", "client_acme")[i % 2],
            job_type=("TRAINING", "BATCH_PREDICTION", "PIPELINE_RUN")[i % 3],
            framework=("pytorch", "jax")[i % 2],
            status=("SUCCEEDED", "SUCCEEDED", "FAILED", "RUNNING", "SUCCEEDED")[i % 5],
            machine_type=("n1-standard-4", "a2-highgpu-1g")[i % 2 if i % 7 else 0],
            gpu_type="NVIDIA_TESLA_A100" if i % 4 == 1 else None,
            gpu_count=1 if i % 4 == 1 else 0,
            gpu_hours=0.5 if i % 4 == 1 else 0.0,
            duration_seconds=(i * 37) % 700 + 50,
            cost_usd=round(0.37 * i, 6),
        ))
    return events(spark, rows).cache()


@pytest.fixture(scope="module")
def inc(ev, tenants):
    return inline_incidents(ev, tenants).cache()


def values(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize(
    "name, build",
    [
        ("daily_cost_summary", reports.daily_cost_summary),
        ("latency_by_framework", reports.latency_by_framework),
        ("weekly_gpu_spend", reports.weekly_gpu_spend),
    ],
)
def test_sql_reports_equal_the_functions(spark, ev, name, build):
    ev.createOrReplaceTempView("job_events")
    got = reports.report_sql(spark, name, tenant_id="client_acme", since_date="2024-01-10")
    want = build(ev, "2024-01-10", tenant="client_acme")
    assert values(got) == values(want) and want.count() > 0


def test_sql_open_incidents_equal_the_function(spark, inc):
    inc.createOrReplaceTempView("incidents")
    got = reports.report_sql(spark, "open_incidents_ranked", tenant_id="client_demo", as_of=str(AS_OF))
    want = open_incidents(inc, AS_OF, tenant="client_demo")
    assert [r.incident_id for r in got.collect()] == [r.incident_id for r in want.collect()]
    assert values(got) == values(want)


def test_report_order(ev):
    rows = reports.daily_cost_summary(ev, SINCE).collect()
    keys = [(-r.run_date.toordinal(), r.job_type) for r in rows]
    assert keys == sorted(keys)
    hours = [r.p95_hours for r in reports.latency_by_framework(ev, SINCE).collect()]
    assert hours == sorted(hours, reverse=True)


def test_latency_report_needs_five_jobs(spark):
    few = events(spark, [event(i, framework="jax") for i in range(4)])
    assert reports.latency_by_framework(few, SINCE).count() == 0
    assert reports.latency_by_framework(few, SINCE, min_jobs=4).count() == 1


def test_named_views(spark, ev):
    reports.create_views(ev)
    assert spark.table("v_job_success_rate").agg(F.sum("total_jobs")).first()[0] == 240
    assert spark.table("v_gpu_spend_weekly").count() > 0


def test_totals_agree_between_datasets(ev, tenants):
    daily = reports.daily_cost_summary(ev, SINCE).agg(F.sum("total_jobs"), F.sum("total_cost_usd")).first()
    weekly = finance.weekly_spend_vs_budget(ev, tenants, SINCE).agg(F.sum("total_cost")).first()
    split = operations.resource_cost_split(ev, SINCE).agg(F.sum("job_count"), F.sum("total_cost")).first()
    assert daily[0] == split[0] == 240
    assert daily[1] == pytest.approx(split[1], abs=0.01) and daily[1] == pytest.approx(weekly[0], abs=0.1)
    rows = metrics.daily_metrics(ev, tenants, AS_OF).collect()
    assert all(r.succeeded_jobs + r.failed_jobs <= r.total_jobs for r in rows)


def test_row_order_does_not_change_results(ev, tenants):
    shuffled = ev.orderBy(F.xxhash64("event_id")).repartition(3)
    for build in (
        lambda d: reports.daily_cost_summary(d, SINCE),
        lambda d: metrics.daily_metrics(d, tenants, AS_OF),
        lambda d: finance.top_expensive_jobs(d, SINCE),
    ):
        assert values(build(ev)) == values(build(shuffled))


def test_over_budget_flags(spark, tenants):
    # 428.571428... is 120 % of the daily budget of client_demo (2500 a week).
    rows = [event(1, cost_usd=300.0), event(2, job_type="PIPELINE_RUN", cost_usd=200.0)]
    got = by(metrics.daily_metrics(events(spark, rows), tenants, AS_OF).collect(), "job_type")
    assert [got[t].is_over_budget for t in ("TRAINING", "PIPELINE_RUN")] == [False, False]
    assert all(r.tenant_day_over_budget for r in got.values())
    alone = metrics.daily_metrics(events(spark, [event(1, cost_usd=428.58)]), tenants, AS_OF).first()
    assert alone.is_over_budget and alone.computed_at == AS_OF
    unknown = metrics.daily_metrics(events(spark, [event(1, tenant_id="x")]), tenants, AS_OF).first()
    assert unknown.budget_threshold == 5000.0 / 7


def test_kpis_cover_silent_tenants(ev, inc, tenants):
    got = by(operations.technical_kpis(ev, inc, tenants, SINCE).collect(), "tenant_id")
    silent = got["client_internal"]
    assert tuple(silent)[1:] == (0, 0.0, 0.0, 0, 0)
    assert got["client_demo"].total_jobs == 120


def test_heatmap_pivot_is_monday_first_and_filled(spark):
    sunday, monday = AS_OF.replace(day=28, hour=23), AS_OF.replace(day=29, hour=0)
    rows = [event(i, status="FAILED", started_at=t) for i, t in enumerate((sunday, monday, monday))]
    got = operations.failure_heatmap_pivot(events(spark, rows), SINCE).collect()
    assert [r.weekday_name for r in got] == ["Mon", "Sun"]
    assert (got[0].h00, got[0].h23, got[1].h00, got[1].h23) == (2, 0, 0, 1)


def test_budget_status_and_notices(spark, tenants):
    rows = [event(1, cost_usd=2500.0), event(2, cost_usd=4000.0, tenant_id="client_acme"),
            event(3, cost_usd=20000.0, tenant_id="client_internal"),
            event(4, minutes_ago=60 * 24 * 9, cost_usd=1e6)]
    status = finance.budget_status(events(spark, rows), tenants, AS_OF)
    got = by(status.collect(), "tenant_id")
    assert (got["client_demo"].budget_status, got["client_demo"].remaining) == ("Over budget", 0.0)
    assert (got["client_acme"].budget_status, got["client_acme"].pct_used) == ("At risk", 80.0)
    notices = finance.overrun_notices(status, tenants).collect()
    assert [(r.tenant_id, r.alert_email) for r in notices] == [("client_demo", "demo@ops.example")]


def test_projection_over_one_day_window(spark, tenants):
    got = by(finance.spend_projection(events(spark, [event(1, cost_usd=10.0)]), tenants, date(2024, 1, 30), AS_OF)
             .collect(), "tenant_id")
    assert (got["client_demo"].days_in_range, got["client_demo"].projected_30d) == (1, 300.0)
    assert got["client_acme"].total_spend == 0.0


def test_top_jobs_break_ties_by_id(spark):
    ev = events(spark, [event(f"x{i:02d}", cost_usd=1.0) for i in range(15)])
    for tenant in (None, "client_demo"):
        got = [r.event_id for r in finance.top_expensive_jobs(ev, SINCE, tenant=tenant).collect()]
        assert got == [f"x{i:02d}" for i in range(10)]


@pytest.mark.parametrize("bad, severity", [(0, None), (1, "MEDIUM"), (3, "MEDIUM"), (4, "HIGH")])
def test_ingest_window(spark, bad, severity):
    rows = [event(i, 5, status="FAILED" if i < bad else "SUCCEEDED") for i in range(6)] + [event(9, 30, status="FAILED")]
    ev = events(spark, rows)
    status = operations.ingest_window_status(ev, AS_OF).first()
    assert tuple(status) == (6, bad, bad > 0, severity)
    found = operations.ingest_window_incident(ev, AS_OF).collect()
    assert [(r.tenant_id, r.severity, r.metric_value) for r in found] == ([("system", severity, float(bad))] if bad else [])


def test_sla_edges(spark, tenants):
    rows = [event(i, duration_seconds=10800 + (i == 0)) for i in range(4)]
    got = operations.sla_breaches(events(spark, rows), tenants, SINCE).collect()
    assert [(r.tenant_id, r.terminal_jobs, r.breaching_jobs, r.p95_breached) for r in got] == [("client_demo", 4, 1, True)]


def test_digest_snapshot_and_rows(ev, inc, tenants):
    snap = by(digest.digest_snapshot(ev, inc, tenants, AS_OF).collect(), "tenant_id")
    assert tuple(snap["client_internal"])[1:] == (0, 0.0, 0, 0.0)
    rows = digest.digest_rows(ev, inc, tenants, AS_OF).collect()
    assert len({r.digest_id for r in rows}) == 3
    again = {r.digest_id for r in digest.digest_rows(ev, inc, tenants, AS_OF).collect()}
    assert {r.digest_id for r in rows} == again
    demo = by(rows, "tenant_id")["client_demo"]
    assert demo.summary_text.startswith("[client_demo] DAILY digest: 5 jobs in 24h, $")
    weekly = digest.digest_rows(ev, inc, tenants, AS_OF, period="WEEKLY")
    assert not {r.digest_id for r in weekly.collect()} & again


def test_digest_weekly_peaks_prefer_the_earliest_day(spark, tenants, inc):
    rows = [event(i, 60 * 24 * d + 5, cost_usd=c) for i, (d, c) in enumerate([(0, 5.0), (2, 5.0), (3, 1.0), (5, 1.0)])]
    got = by(digest.digest_weekly_metrics(events(spark, rows), inc.limit(0), tenants, AS_OF).collect(), "tenant_id")
    demo = got["client_demo"]
    assert (demo.peak_day, demo.peak_day_cost) == (date(2024, 1, 28), 5.0)
    assert (demo.trough_day, demo.trough_day_cost) == (date(2024, 1, 25), 1.0)
    assert got["client_acme"].peak_day is None and got["client_acme"].success_rate_week is None


def test_digest_text(ev, inc, tenants):
    m = digest.digest_daily_metrics(ev, inc, tenants, AS_OF)
    assert len(m.columns) == 15
    texts = by(digest.render_digest(m, inc, tenants, AS_OF, top=1).collect(), "tenant_id")
    lines = texts["client_demo"].digest_text.split("\n")
    assert lines[:5] == ["Tenant: Demo Client", "Digest date: 2024-01-30", "", "## Spend & budget", lines[4]]
    assert "- Weekly budget: $2,500.00" in lines and "- Daily budget (prorated): $357.14" in lines
    assert "- Recent incidents (severity / type / title):" in lines
    assert sum(x.startswith("  - HIGH: JOB_FAILURE — Job failed: ") for x in lines) == 1
    assert "JSON object" in lines[-1]
    silent = texts["client_internal"].digest_text
    assert "Recent incidents" not in silent and "- Success rate today: n/a%" in silent


def test_weekly_digest_text(ev, inc, tenants):
    m = digest.digest_weekly_metrics(ev, inc, tenants, AS_OF)
    assert len(m.columns) == 18
    texts = by(digest.render_digest(m, inc, tenants, AS_OF, period="WEEKLY", top=2).collect(), "tenant_id")
    text = texts["client_acme"].digest_text
    listed = [x for x in text.split("\n") if x.startswith("  - ")]
    total = by(m.collect(), "tenant_id")["client_acme"].incidents_total
    assert len(listed) == 3 and listed[-1] == f"  - and {total - 2} more"
    assert "Week window: 2024-01-24 through 2024-01-30" in text and "- Peak day: 2024-01-" in text
    assert "ACME Corp" in text and "$5,000.00" in text and "JSON object" in text
    assert "- Detail:" in text and f"- Total: {total}, CRITICAL: " in text


@pytest.mark.parametrize("period", ["DAILY", "WEEKLY"])
def test_written_digests_are_the_rendered_ones(ev, inc, tenants, tmp_path, period):
    build = digest.digest_daily_metrics if period == "DAILY" else digest.digest_weekly_metrics
    m = build(ev, inc, tenants, AS_OF)
    want = by(digest.render_digest(m, inc, tenants, AS_OF, period=period, top=10**6).collect(), "tenant_id")
    digest.write_digest_texts(digest.digest_lines(m, inc, tenants, AS_OF, period), str(tmp_path / "out"))
    for tenant, row in want.items():
        files = sorted((tmp_path / "out" / f"tenant_id={tenant}").glob("part-*.txt"))
        assert "".join(f.read_text() for f in files) == row.digest_text + "\n"


def test_approximate_mode_keeps_counts(ev):
    exact = by(reports.daily_cost_summary(ev, SINCE).collect(), "run_date", "tenant_id", "job_type")
    rough = by(reports.daily_cost_summary(ev, SINCE, approx=True).collect(), "run_date", "tenant_id", "job_type")
    assert {k: (r.total_jobs, r.total_cost_usd) for k, r in exact.items()} == {
        k: (r.total_jobs, r.total_cost_usd) for k, r in rough.items()
    }
