"""Incident rows: per-event rules, conversion of findings, and incident queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import Moment, clip, minutes_between, stamp, today, trailing
from ..functions.numeric import pct, real
from ..functions.text import clipped, fixed, say, stable_id, usd
from ..functions.tiers import severity_rank
from ..schemas import INCIDENTS
from ..settings import RuleLimits
from ..sources.dimensions import with_budget


def inline_incidents(
    ev: DataFrame,
    ten: DataFrame,
    limits: RuleLimits = RuleLimits(),
    as_of: Moment | None = None,
) -> DataFrame:
    """Rules on single events; one event may raise a failure, a spike and an overrun.

    Stateless, so the same call serves a batch and a stream. A missing
    duration or cost raises nothing. The id depends only on rule and event,
    so a replay produces the same incidents again.
    """
    seconds, cost = F.col("duration_seconds"), real("cost_usd")
    daily = F.col("budget_weekly") / F.lit(7.0)
    slow, pricey = F.lit(limits.baseline_seconds * limits.spike_factor), daily * F.lit(limits.cost_share)
    rules = {
        "JOB_FAILURE": F.col("status") == "FAILED",
        "LATENCY_SPIKE": seconds > slow,
        "COST_OVERRUN": cost > pricey,
    }
    # Which rules hit is decided first and cheaply; texts are built only for
    # the incidents that exist.
    hits = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in rules.items()]))
    detected = F.col("completed_at") if as_of is None else stamp(as_of)
    any_hit = F.lit(False)
    for test in rules.values():
        any_hit = any_hit | F.coalesce(test, F.lit(False))
    raised = with_budget(ev, ten).filter(any_hit).withColumn("incident_type", F.explode(hits))

    def by_kind(failure, spike, overrun) -> Column:
        kind = F.col("incident_type")
        return F.when(kind == "JOB_FAILURE", failure).when(kind == "LATENCY_SPIKE", spike).otherwise(overrun)

    return raised.select(
        stable_id(F.col("incident_type"), F.col("tenant_id"), F.col("event_id")).alias("incident_id"),
        "event_id", "tenant_id", "job_id", "incident_type",
        by_kind(
            F.lit("HIGH"), F.lit("MEDIUM"),
            F.when(cost > daily * F.lit(limits.cost_share_high), "HIGH").otherwise("MEDIUM"),
        ).alias("severity"),
        by_kind(
            say("Job failed: ", F.col("job_name")),
            say("Latency spike: ", F.col("job_name")),
            say("High-cost job: ", F.col("job_name"), " ($", fixed(cost, 2), ")"),
        ).alias("title"),
        by_kind(
            say(F.col("job_id"), " (", F.col("job_type"), ") ended as FAILED after ", seconds,
                "s on ", F.col("machine_type"), "."),
            say("Took ", seconds, "s (", fixed(seconds / F.lit(3600.0), 1), "h), ",
                fixed(seconds / F.lit(float(limits.baseline_seconds)), 1), "x the baseline of ",
                str(limits.baseline_seconds), "s."),
            say("One job used $", fixed(cost, 4), ", ", fixed(pct(cost, daily), 1),
                "% of the daily budget of ", usd(daily), "."),
        ).alias("description"),
        by_kind(seconds.cast("double"), seconds.cast("double"), cost).alias("metric_value"),
        by_kind(F.lit(None).cast("double"), slow, pricey).alias("threshold_value"),
        by_kind(
            F.lit("Read the job log for memory or input-schema errors and check that the "
                  "batch size fits the accelerator."),
            F.lit("Look for a slow input stage; more replicas or smaller partitions may help."),
            F.lit("Check the accelerator choice; a smaller one may do for test runs."),
        ).alias("recommended_action"),
        F.lit("OPEN").alias("status"),
        detected.alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.to_date("started_at").alias("subject_date"),
    )


def checks_to_incidents(checks: DataFrame, as_of: Moment) -> DataFrame:
    """One incident per failed check; the id repeats within the hour of ``as_of``."""
    hour = F.date_format(stamp(as_of), "yyyy-MM-dd HH")
    return checks.filter(~F.col("passed")).select(
        stable_id(F.upper("check_name"), F.col("tenant_id"), hour).alias("incident_id"),
        "tenant_id",
        F.lit(None).cast("string").alias("job_id"),
        F.upper("check_name").alias("incident_type"),
        "severity",
        say("[", F.col("tenant_id"), "] ", F.col("check_name"), ": ", clipped("message", 120)).alias("title"),
        F.col("message").alias("description"),
        F.col("metric").alias("metric_value"),
        F.col("threshold").alias("threshold_value"),
        F.nullif("action", F.lit("")).alias("recommended_action"),
        F.lit("OPEN").alias("status"),
        stamp(as_of).alias("detected_at"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(today(as_of)).alias("subject_date"),
    )


def anomalies_to_incidents(anomalies: DataFrame, as_of: Moment) -> DataFrame:
    return anomalies.select(
        F.col("anomaly_id").alias("incident_id"),
        "tenant_id", "job_id",
        F.col("anomaly_type").alias("incident_type"),
        "severity", "title", "description", "metric_value", "threshold_value",
        "recommended_action",
        F.lit("OPEN").alias("status"),
        "detected_at",
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.lit(today(as_of)).alias("subject_date"),
    )


def as_stored_incidents(inc: DataFrame) -> DataFrame:
    shaped = [F.col(f.name).cast(f.dataType).alias(f.name) for f in INCIDENTS]
    return inc.select(*shaped, F.to_date("detected_at").alias("detected_date"), "subject_date")


def _by_urgency() -> list[Column]:
    return [
        severity_rank("severity").asc(),
        F.col("detected_at").desc_nulls_last(),
        F.col("incident_id").asc(),
    ]


def open_incidents(
    inc: DataFrame, as_of: Moment, tenant: str | None = None, top: int | None = None
) -> DataFrame:
    """Open incidents, worst and newest first, with their age in minutes.

    ``top`` keeps that many per tenant (the dashboard list).
    """
    rows = inc.filter(F.col("status") == "OPEN")
    if tenant is not None:
        rows = rows.filter(F.col("tenant_id") == tenant)
    if top is not None:
        w = W.partitionBy("tenant_id").orderBy(*_by_urgency())
        rows = rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= top).drop("_n")
    columns = [
        c for c in (
            "incident_id", "tenant_id", "job_id", "incident_type", "severity", "title",
            "description", "metric_value", "threshold_value", "recommended_action", "detected_at",
        ) if c in rows.columns
    ]
    age = minutes_between("detected_at", stamp(as_of)).alias("age_minutes")
    return rows.orderBy(*_by_urgency()).select(*columns, age)


def escalations(inc: DataFrame, as_of: Moment, hours: float = 1) -> DataFrame:
    """Critical open incidents of the last hour, newest first."""
    rows = inc.filter((F.col("severity") == "CRITICAL") & (F.col("status") == "OPEN"))
    rows = clip(rows, "detected_at", **trailing(as_of, hours=hours))
    columns = ["incident_id", "tenant_id", "incident_type", "title", "detected_at"]
    return rows.select(*[c for c in columns if c in rows.columns]).orderBy(
        F.col("detected_at").desc_nulls_last(), "incident_id"
    )
