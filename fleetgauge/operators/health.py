"""Six health checks for all tenants at once.

The measures of every check come out of one aggregation by tenant. Staleness
is the one check that looks at all time. On a table stored by day (with the
``ingest_date`` column) it gets its own narrow scan, because folding it into
the others would make them read the whole history: first the last day of
arrivals, then, only for tenants that were silent in it, their older
partitions. Given the ledger of arrivals, it opens no event file.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import Moment, between, calendar_day, clip, minutes_between, moment, stamp
from ..functions.clock import trailing
from ..functions.numeric import from_units, hit, pct, rnd, units
from ..functions.quantiles import summarize
from ..functions.text import fixed, say
from ..functions.tiers import above, spend_severity, success_severity
from ..settings import TERMINAL, HealthLimits

CHECKS = (
    "success_rate_1h",
    "success_rate_24h",
    "p95_latency",
    "daily_budget",
    "pipeline_staleness",
    "gpu_cost_efficiency",
)


def _measures(as_of: Moment, checks: Sequence[str], lim: HealthLimits) -> dict[str, Column]:
    """Additive per-row measures the given checks need."""
    last_hour = between("started_at", **trailing(as_of, hours=1))
    last_day = between("started_at", **trailing(as_of, hours=24))
    this_day = between("started_at", **calendar_day(as_of))
    ok, gpu = F.col("status") == "SUCCEEDED", F.col("gpu_count") > 0
    short = F.col("duration_seconds") < lim.short_job_seconds
    m: dict[str, Column] = {}
    if "success_rate_1h" in checks:
        m |= {"n_1h": hit(last_hour), "ok_1h": hit(last_hour & ok)}
    if "success_rate_24h" in checks:
        m |= {"n_24h": hit(last_day), "ok_24h": hit(last_day & ok)}
    if "daily_budget" in checks:
        m |= {"spend_units": F.when(this_day, units("cost_usd"))}
    if "gpu_cost_efficiency" in checks:
        m |= {"gpu_n": hit(last_day & gpu), "gpu_short": hit(last_day & gpu & short)}
    return m


def last_ingested(ev: DataFrame, ten: DataFrame, as_of: Moment, hours: float = 24) -> DataFrame:
    """Newest arrival per tenant, exact over all time; tenants without rows are absent."""
    upto = moment(as_of)
    newest = F.max("ingested_at").alias("last_ingested_at")
    if "ingest_date" not in ev.columns:
        return clip(ev, "ingested_at", until=upto).groupBy("tenant_id").agg(newest)
    recent = clip(ev, "ingested_at", **trailing(as_of, hours=hours)).groupBy("tenant_id").agg(newest)
    silent = ten.select("tenant_id").join(recent, "tenant_id", "left_anti")
    older = clip(ev, "ingested_at", until=upto - timedelta(hours=hours))
    older = older.join(silent, "tenant_id", "left_semi").groupBy("tenant_id").agg(newest)
    return recent.unionByName(older)


def tenant_health(
    ev: DataFrame,
    ten: DataFrame,
    as_of: Moment,
    limits: HealthLimits = HealthLimits(),
    checks: Sequence[str] = CHECKS,
    approx: bool = False,
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """One row per tenant with every measure the ``checks`` need.

    ``arrivals`` (tenant_id, ingested_at, ingest_date) stands for the events where arrival times are asked for.
    """
    measures = _measures(as_of, checks, limits)
    wants_p95, wants_age = "p95_latency" in checks, "pipeline_staleness" in checks
    split_scan = wants_age and (arrivals is not None or "ingest_date" in ev.columns)
    rows, maxima = ev, {}
    if wants_age and not split_scan:
        arrived = between("ingested_at", until=moment(as_of))
        maxima["last_ingested_at"] = F.when(arrived, F.col("ingested_at"))
    else:
        day = calendar_day(as_of)
        rows = clip(ev, since=moment(as_of) - timedelta(hours=24), before=day["before"])
    result = ten.select("tenant_id", "budget_weekly")
    if measures or wants_p95 or maxima:
        in_p95 = between("started_at", **trailing(as_of, hours=24)) & F.col("status").isin(*TERMINAL)
        result = result.join(
            summarize(
                rows, ["tenant_id"], measures, maxima=maxima, approx=approx,
                value="duration_seconds" if wants_p95 else None, at=(0.95,),
                counted=in_p95 if wants_p95 else None,
            ),
            "tenant_id", "left",
        )
    if split_scan:
        result = result.join(last_ingested(ev if arrivals is None else arrivals, ten, as_of), "tenant_id", "left")
    return result


def _check(name, known, passed, severity, metric, threshold, message, action, missing) -> Column:
    """One check as a struct; ``missing`` is (passed, severity, message, action) without data."""
    none = F.lit(None).cast("double")
    absent_ok, absent_severity, absent_message, absent_action = missing
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(known, passed).otherwise(F.lit(absent_ok)).alias("passed"),
        F.when(known, severity).otherwise(F.lit(absent_severity)).alias("severity"),
        F.when(known, metric).otherwise(none).alias("metric"),
        F.when(known, F.lit(threshold) if isinstance(threshold, float) else threshold)
        .otherwise(none).alias("threshold"),
        F.when(known, message).otherwise(F.lit(absent_message)).alias("message"),
        F.when(~known, F.lit(absent_action)).when(passed, F.lit(""))
        .otherwise(F.lit(action) if isinstance(action, str) else action).alias("action"),
    )


def _rate_check(name, n, ok, window, minimum, severity, advice) -> Column:
    n, ok = F.coalesce(n, F.lit(0)), F.coalesce(ok, F.lit(0))
    rate = pct(ok, n)
    return _check(
        name, n > 0, rate >= minimum, severity(rate), rnd(rate, 2), minimum,
        say(f"{window} success rate: ", fixed(rate, 1), "% (", ok, "/", n, " jobs)"),
        advice, (True, "LOW", f"No jobs in the last {window}.", ""),
    )


def _as_checks(as_of: Moment, checks: Sequence[str], lim: HealthLimits) -> list[Column]:
    built: dict[str, Column] = {}
    if "success_rate_1h" in checks:
        built["success_rate_1h"] = _rate_check(
            "success_rate_1h", F.col("n_1h"), F.col("ok_1h"), "1h", lim.success_1h_min,
            lambda rate: success_severity(rate, lim),
            "Look at the newest failures first: memory, input schema, infrastructure.",
        )
    if "success_rate_24h" in checks:
        built["success_rate_24h"] = _rate_check(
            "success_rate_24h", F.col("n_24h"), F.col("ok_24h"), "24h", lim.success_24h_min,
            lambda rate: F.lit("MEDIUM"),
            "Compare with the day before and consider rolling back a recent change.",
        )
    if "p95_latency" in checks:
        p95, most = rnd(F.element_at("q", 1), 2), float(lim.p95_max_seconds)
        built["p95_latency"] = _check(
            "p95_latency", p95.isNotNull(), p95 <= most,
            above(p95, (most * lim.p95_high_factor, "HIGH"), otherwise="MEDIUM"),
            rnd(p95, 1), most,
            say("p95 job duration: ", fixed(p95 / F.lit(3600.0), 2),
                f"h (limit {most / 3600:.1f}h)"),
            "Slower than agreed: check data volume, provisioning and batch size.",
            (True, "LOW", "Not enough data for a p95 duration.", ""),
        )
    if "daily_budget" in checks:
        daily = F.col("budget_weekly") / F.lit(7.0)
        spend = F.coalesce(from_units("spend_units"), F.lit(0.0))
        limit = daily * F.lit(1 + lim.overrun_pct / 100)
        used = F.coalesce(pct(spend, daily), F.lit(0.0))
        built["daily_budget"] = _check(
            "daily_budget", F.lit(True), spend <= limit, spend_severity(used, lim),
            rnd(spend, 4), rnd(limit, 4),
            say("Daily spend: $", fixed(spend, 2), " (", fixed(used, 0), "% of $",
                fixed(daily, 2), " daily budget)"),
            say("Over budget by ", fixed(used - F.lit(100.0), 0),
                "%: pause what can wait and review accelerator choices."),
            (True, "LOW", "", ""),
        )
    if "pipeline_staleness" in checks:
        age = minutes_between("last_ingested_at", stamp(as_of))
        built["pipeline_staleness"] = _check(
            "pipeline_staleness", age.isNotNull(), age <= lim.stale_minutes,
            above(age, (lim.stale_high_minutes, "HIGH"), otherwise="MEDIUM"),
            age.cast("double"), float(lim.stale_minutes),
            say("Last event ingested ", age, " minutes ago."),
            "Nothing is arriving: check that the stream is running and fed.",
            (False, "HIGH", "No events found for this tenant.",
             "Check that events are being sent and read."),
        )
    if "gpu_cost_efficiency" in checks:
        n, short = (F.coalesce(F.col(c), F.lit(0)) for c in ("gpu_n", "gpu_short"))
        waste = pct(short, n)
        built["gpu_cost_efficiency"] = _check(
            "gpu_cost_efficiency", n > 0, waste < lim.gpu_waste_max_pct, F.lit("MEDIUM"),
            rnd(waste, 1), lim.gpu_waste_max_pct,
            say(short, "/", n, f" GPU jobs ended within {lim.short_job_seconds}s (",
                fixed(waste, 1), "% potential waste)"),
            "Move very short jobs to machines without an accelerator.",
            (True, "LOW", "No GPU jobs in the last 24h.", ""),
        )
    return [built[c] for c in checks]


def health_checks(
    ev: DataFrame,
    ten: DataFrame,
    as_of: Moment,
    limits: HealthLimits = HealthLimits(),
    checks: Sequence[str] = CHECKS,
    approx: bool = False,
    arrivals: DataFrame | None = None,
) -> DataFrame:
    """One row per tenant and check: name, passed, severity, metric, threshold, message, action."""
    wide = tenant_health(ev, ten, as_of, limits, checks, approx, arrivals)
    rows = F.array(*_as_checks(as_of, checks, limits))
    return wide.select("tenant_id", F.explode(rows).alias("c")).select("tenant_id", "c.*")


def health_report(checks: DataFrame, as_of: Moment) -> DataFrame:
    """Totals per tenant: checks run, passed, and incidents to open."""
    return checks.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("checks_total"),
        F.sum(hit(F.col("passed"))).alias("checks_passed"),
        F.sum(hit(~F.col("passed"))).alias("incidents_opened"),
    ).withColumn("run_at", stamp(as_of))


def health_run_summary(checks: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row: tenants checked, incidents opened, anomalies flagged."""
    per_tenant = checks.groupBy("tenant_id").agg(F.sum(hit(~F.col("passed"))).alias("failed"))
    counted = per_tenant.agg(
        F.count(F.lit(1)).alias("tenants_checked"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("incidents_opened"),
    ).withColumn("anomalies_flagged", F.lit(0).cast("bigint"))
    flagged = anomalies.agg(F.count(F.lit(1)).alias("anomalies_flagged")).select(
        F.lit(0).cast("bigint").alias("tenants_checked"),
        F.lit(0).cast("bigint").alias("incidents_opened"),
        "anomalies_flagged",
    )
    return counted.unionByName(flagged).agg(
        *[F.sum(c).alias(c) for c in ("tenants_checked", "incidents_opened", "anomalies_flagged")]
    )
