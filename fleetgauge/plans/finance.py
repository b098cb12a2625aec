"""Datasets of the finance view."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import Moment, clip, day_start, moment, today, week_start
from ..functions.numeric import from_units, hours, pct, real, rnd
from ..functions.quantiles import summarize
from ..functions.tiers import budget_label
from ..operators.detect import highest_per
from ..sources.dimensions import with_budget
from ..sources.events import scan_events
from .measures import amounts, counts, total


def budget_status(ev: DataFrame, ten: DataFrame, as_of: Moment, days: int = 7) -> DataFrame:
    """Spend since ``days`` before today against the weekly budget, for every tenant."""
    since = day_start(today(as_of)) - timedelta(days=days)
    rows = clip(ev, since=since, until=moment(as_of))
    spent = summarize(rows, ["tenant_id"], amounts("cost_usd"))
    joined = ten.select("tenant_id", "budget_weekly").join(spent, "tenant_id", "left")
    spend = F.coalesce(from_units("cost_usd_u"), F.lit(0.0))
    used = F.coalesce(pct(spend, "budget_weekly"), F.lit(0.0))
    return joined.select(
        "tenant_id", "budget_weekly",
        rnd(spend, 4).alias("week_spend"),
        rnd(used, 2).alias("pct_used"),
        rnd(F.greatest(F.col("budget_weekly") - spend, F.lit(0.0)), 4).alias("remaining"),
        budget_label(used).alias("budget_status"),
    )


def overrun_notices(status: DataFrame, ten: DataFrame) -> DataFrame:
    """Tenants over budget that want to be told, with the address to use."""
    wanted = ten.filter(F.col("notify_on_overrun")).select("tenant_id", "display_name", "alert_email")
    over = status.filter(F.col("budget_status") == "Over budget")
    return over.join(wanted, "tenant_id").select(
        "tenant_id", "display_name", "alert_email", "week_spend", "budget_weekly", "pct_used"
    )


def spend_projection(ev: DataFrame, ten: DataFrame, since, as_of: Moment) -> DataFrame:
    """Total, daily mean, 30-day projection and how that compares with the budget."""
    first = moment(since).date()
    days = (today(as_of) - first).days or 1
    rows = clip(ev, since=day_start(first), until=moment(as_of))
    spent = summarize(rows, ["tenant_id"], amounts("cost_usd"))
    joined = ten.select("tenant_id", "budget_weekly").join(spent, "tenant_id", "left")
    spend = F.coalesce(from_units("cost_usd_u"), F.lit(0.0))
    average = spend / F.lit(float(days))
    projected = average * F.lit(30.0)
    monthly = F.col("budget_weekly") / F.lit(7.0) * F.lit(30.0)
    return joined.select(
        "tenant_id",
        F.lit(days).cast("bigint").alias("days_in_range"),
        rnd(spend, 4).alias("total_spend"),
        rnd(average, 4).alias("daily_average"),
        rnd(F.col("budget_weekly") / F.lit(7.0), 4).alias("daily_budget"),
        rnd(projected, 2).alias("projected_30d"),
        rnd(monthly, 2).alias("monthly_budget"),
        rnd(F.coalesce(pct(projected, monthly), F.lit(0.0)), 2).alias("pct_of_budget"),
        rnd(projected - monthly, 2).alias("difference"),
    )


def weekly_spend_vs_budget(
    ev: DataFrame, ten: DataFrame, since, tenant: str | None = None
) -> DataFrame:
    """Spend per tenant and week next to the weekly budget."""
    rows = scan_events(ev, since, tenant).withColumn("week_start", week_start("started_at"))
    weekly = summarize(rows, ["tenant_id", "week_start"], amounts("cost_usd"))
    return with_budget(weekly, ten).select(
        "tenant_id", "week_start",
        total("cost_usd", 2).alias("total_cost"),
        F.col("budget_weekly").alias("weekly_budget"),
    ).orderBy("tenant_id", "week_start")


def spend_by_job_type(ev: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """Spend per tenant and job type."""
    grouped = summarize(scan_events(ev, since, tenant), ["tenant_id", "job_type"], amounts("cost_usd"))
    return grouped.select("tenant_id", "job_type", total("cost_usd", 4).alias("cost"))


def top_expensive_jobs(ev: DataFrame, since, tenant: str | None = None, k: int = 10) -> DataFrame:
    """The ``k`` costliest jobs of each tenant, ties by event id."""
    rows = scan_events(ev, since, tenant).select(
        "event_id", "tenant_id", "job_name", "job_type", "machine_type", real("cost_usd").alias("cost_usd"),
        "duration_seconds", "status", "started_at",
    )
    if tenant is not None:
        best = rows.orderBy(F.col("cost_usd").desc_nulls_last(), F.col("event_id").asc()).limit(k)
    else:
        best = highest_per(rows, ["tenant_id"], "cost_usd", "event_id", k)
    return best.select(
        "tenant_id", "event_id", "job_name", "job_type", "machine_type",
        rnd("cost_usd", 4).alias("cost_usd"),
        hours("duration_seconds", 2).alias("hours"),
        "status",
        F.to_date("started_at").alias("run_date"),
    )


def daily_spend(ev: DataFrame, ten: DataFrame, since, tenant: str | None = None) -> DataFrame:
    """Jobs, hours and spend per tenant and day with the share of the daily budget."""
    rows = scan_events(ev, since, tenant).withColumn("date", F.to_date("started_at"))
    daily = summarize(
        rows, ["tenant_id", "date"],
        {**counts(), **amounts("gpu_hours", "cpu_hours", "cost_usd")},
    )
    budget = F.col("budget_weekly") / F.lit(7.0)
    return with_budget(daily, ten).select(
        "tenant_id", "date",
        F.col("jobs_n").alias("jobs"),
        F.col("ok_n").alias("succeeded"),
        F.col("failed_n").alias("failed"),
        total("gpu_hours", 2).alias("gpu_hours"),
        total("cpu_hours", 2).alias("cpu_hours"),
        total("cost_usd", 4).alias("total_cost_usd"),
        rnd(budget, 2).alias("daily_budget"),
        rnd(pct(from_units("cost_usd_u"), budget), 1).alias("pct_of_budget"),
    ).orderBy(F.col("date").desc_nulls_last(), "tenant_id")
