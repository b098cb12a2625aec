"""Datasets of the operations view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import Moment, between, clip, minutes_between, stamp, trailing
from ..functions.clock import week_start, weekday
from ..functions.numeric import hit, hours, pct, rnd
from ..functions.quantiles import summarize
from ..functions.text import say, stable_id
from ..functions.tiers import above, budget_label, spend_severity, success_severity
from ..settings import TERMINAL, WEEKDAYS
from ..sources.dimensions import with_budget
from ..sources.events import scan_events
from .measures import amounts, counts, total, zero


def technical_kpis(ev: DataFrame, inc: DataFrame, ten: DataFrame, since, approx=False) -> DataFrame:
    """Headline numbers per tenant, zero where a tenant has no rows."""
    jobs = summarize(
        scan_events(ev, since), ["tenant_id"], counts(),
        value="duration_seconds", at=(0.95,), approx=approx,
    )
    still_open = inc.filter(F.col("status") == "OPEN").groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("open_n")
    )
    rows = ten.select("tenant_id").join(jobs, "tenant_id", "left")
    rows = rows.join(still_open, "tenant_id", "left")
    return rows.select(
        "tenant_id",
        zero("jobs_n").alias("total_jobs"),
        F.coalesce(rnd(pct("ok_n", "jobs_n"), 1), F.lit(0.0)).alias("success_rate"),
        F.coalesce(hours(F.element_at("q", 1), 2), F.lit(0.0)).alias("p95_hours"),
        zero("failed_n").alias("total_failures"),
        zero("open_n").alias("open_incidents"),
    )


def volume_trend(ev: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """Jobs and success share per tenant and day."""
    rows = scan_events(ev, since, tenant).withColumn("day", F.to_date("started_at"))
    grouped = summarize(rows, ["tenant_id", "day"], counts())
    return grouped.select(
        "tenant_id", "day",
        F.col("jobs_n").alias("total_jobs"),
        rnd(pct("ok_n", "jobs_n"), 1).alias("success_rate"),
    ).orderBy("day", "tenant_id")


def latency_box(ev: DataFrame, since, tenant: str | None = None, approx: bool = False) -> DataFrame:
    """Box-plot numbers of finished jobs per tenant and job type, in hours."""
    rows = scan_events(ev, since, tenant).filter(F.col("status").isin(*TERMINAL))
    seconds = F.col("duration_seconds")
    grouped = summarize(
        rows, ["tenant_id", "job_type"], {"jobs_n": F.lit(1).cast("bigint")},
        value="duration_seconds", at=(0.25, 0.5, 0.75),
        minima={"low": seconds}, maxima={"high": seconds}, approx=approx,
    )
    return grouped.select(
        "tenant_id", "job_type",
        F.col("jobs_n").alias("jobs"),
        hours("low", 3).alias("min_hours"),
        hours(F.element_at("q", 1), 3).alias("q1_hours"),
        hours(F.element_at("q", 2), 3).alias("median_hours"),
        hours(F.element_at("q", 3), 3).alias("q3_hours"),
        hours("high", 3).alias("max_hours"),
    )


def failure_heatmap(ev: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """Failures per tenant, weekday (Sunday 0) and hour."""
    failed = scan_events(ev, since, tenant).filter(F.col("status") == "FAILED")
    return failed.groupBy(
        "tenant_id", weekday("started_at").alias("weekday"),
        F.hour("started_at").cast("bigint").alias("hour"),
    ).agg(F.count(F.lit(1)).alias("failures"))


def failure_heatmap_pivot(ev: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """The heatmap with one column per hour, zero where nothing failed, Monday first."""
    cells = failure_heatmap(ev, since, tenant)
    wide = cells.groupBy("tenant_id", "weekday").pivot("hour", list(range(24))).agg(F.sum("failures"))
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    columns = [F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    monday_first = (F.col("weekday") + 6) % 7
    return wide.orderBy("tenant_id", monday_first).select(
        "tenant_id", names[F.col("weekday").cast("int")].alias("weekday_name"), *columns
    )


def resource_cost_split(ev: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """Cost and jobs with and without accelerator, per tenant and job type."""
    rows = scan_events(ev, since, tenant).withColumn(
        "resource_type", F.when(F.col("gpu_count") > 0, "GPU").otherwise("CPU-only")
    )
    grouped = summarize(
        rows, ["tenant_id", "resource_type", "job_type"],
        {"jobs_n": F.lit(1).cast("bigint"), **amounts("cost_usd")},
    )
    return grouped.select(
        "tenant_id", "resource_type", "job_type",
        total("cost_usd", 4).alias("total_cost"), F.col("jobs_n").alias("job_count"),
    )


def ingest_window_status(ev: DataFrame, as_of: Moment, minutes: float = 20, arrivals: DataFrame | None = None) -> DataFrame:
    """One row: events and failures that arrived in the last minutes, and what they amount to.

    ``arrivals`` (ingested_at, events, failures), the ledger's counts, stands for the events where it is given; no event is read then.
    """
    if arrivals is None:
        arrivals = ev.select("ingested_at", F.lit(1).alias("events"), hit(F.col("status") == "FAILED").alias("failures"))
    counted = clip(arrivals, "ingested_at", **trailing(as_of, minutes=minutes)).agg(
        *[zero(F.sum(c)).cast("bigint").alias(c) for c in ("events", "failures")]
    )
    return counted.select(
        "events", "failures",
        (F.col("failures") > 0).alias("opens_incident"),
        F.when(F.col("failures") > 0, above("failures", (3, "HIGH"), otherwise="MEDIUM"))
        .alias("severity"),
    )


def ingest_window_incident(ev: DataFrame, as_of: Moment, minutes: float = 20, arrivals: DataFrame | None = None) -> DataFrame:
    """The incident of tenant "system" for :func:`ingest_window_status`; no row without failures."""
    status = ingest_window_status(ev, as_of, minutes, arrivals).filter("opens_incident")
    window = F.date_format(stamp(as_of), "yyyy-MM-dd HH:mm")
    return status.select(
        stable_id(F.lit("JOB_FAILURE"), F.lit("system"), window).alias("incident_id"),
        F.lit("system").alias("tenant_id"),
        F.lit(None).cast("string").alias("job_id"),
        F.lit("JOB_FAILURE").alias("incident_type"),
        "severity",
        say(F.col("failures"), " job failure(s) in the last ingestion window").alias("title"),
        say(F.col("failures"), " of ", F.col("events"), " events that arrived were FAILED.")
        .alias("description"),
        F.col("failures").cast("double").alias("metric_value"),
        F.lit(None).cast("double").alias("threshold_value"),
        F.lit(None).cast("string").alias("recommended_action"),
        F.lit("OPEN").alias("status"),
        stamp(as_of).alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.to_date(stamp(as_of)).alias("subject_date"),
    )


def window_counts(ev: DataFrame, as_of: Moment) -> DataFrame:
    """Rows per tenant in each trailing window, all windows in one scan."""
    windows = {
        "ingested_20min": between("ingested_at", **trailing(as_of, minutes=20)),
        "ingested_30min": between("ingested_at", **trailing(as_of, minutes=30)),
        "started_1h": between("started_at", **trailing(as_of, hours=1)),
        "started_24h": between("started_at", **trailing(as_of, hours=24)),
        "started_7d": between("started_at", **trailing(as_of, days=7)),
    }
    return ev.groupBy("tenant_id").agg(*[F.sum(hit(c)).alias(n) for n, c in windows.items()])


def time_parts(ev: DataFrame, as_of: Moment) -> DataFrame:
    """Date parts of each event: day, week, weekday, hour, age in minutes."""
    start: Column = F.col("started_at")
    return ev.select(
        "event_id",
        F.to_date(start).alias("run_date"),
        week_start(start).alias("week_start"),
        weekday(start).alias("weekday"),
        F.hour(start).cast("bigint").alias("hour"),
        minutes_between(start, stamp(as_of)).alias("age_minutes"),
        (start + F.expr("INTERVAL '1' HOUR")).alias("plus_one_hour"),
    )


def severity_by_day(ev: DataFrame, ten: DataFrame, since) -> DataFrame:
    """Success and spend of each tenant day with the tier each falls into."""
    rows = scan_events(ev, since).withColumn("day", F.to_date("started_at"))
    grouped = with_budget(
        summarize(rows, ["tenant_id", "day"], {**counts(), **amounts("cost_usd")}), ten
    )
    rate, used = pct("ok_n", "jobs_n"), pct(F.col("cost_usd_u") / F.lit(1e6), F.col("budget_weekly") / F.lit(7.0))
    return grouped.select(
        "tenant_id", "day",
        rnd(rate, 2).alias("success_pct"),
        success_severity(rate).alias("success_severity"),
        rnd(used, 2).alias("spend_pct"),
        spend_severity(used).alias("spend_severity"),
        budget_label(used).alias("spend_label"),
    )


def sla_breaches(ev: DataFrame, ten: DataFrame, since, approx: bool = False) -> DataFrame:
    """Finished jobs longer than the tenant's agreed hours, and whether its p95 is.

    The limit is one constant per tenant, so rows are compared after a join
    with the tenant table only; tenants without an agreement are left out.
    """
    terms = ten.select("tenant_id", "sla_p95_hours").filter(F.col("sla_p95_hours").isNotNull())
    rows = scan_events(ev, since).filter(F.col("status").isin(*TERMINAL))
    rows = rows.join(terms, "tenant_id")
    longer = F.col("duration_seconds") > F.col("sla_p95_hours") * F.lit(3600.0)
    grouped = summarize(
        rows, ["tenant_id"], {"jobs_n": F.lit(1).cast("bigint"), "breach_n": hit(longer)},
        value="duration_seconds", at=(0.95,), maxima={"sla_hours": F.col("sla_p95_hours")},
        approx=approx,
    )
    p95 = F.element_at("q", 1)
    return grouped.select(
        "tenant_id", "sla_hours",
        F.col("jobs_n").alias("terminal_jobs"),
        F.col("breach_n").alias("breaching_jobs"),
        rnd(pct("breach_n", "jobs_n"), 2).alias("breach_pct"),
        hours(p95, 3).alias("p95_hours"),
        (p95 > F.col("sla_hours") * F.lit(3600.0)).alias("p95_breached"),
    )
