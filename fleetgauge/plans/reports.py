"""Report datasets and the two named views.

Every function takes all tenants in one pass; ``tenant`` narrows to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import week_start
from ..functions.numeric import from_units, hit, hours, pct, ratio, rnd
from ..functions.quantiles import summarize
from ..settings import TERMINAL
from ..sources.events import scan_events
from .measures import amounts, counts, known, mean, total


def daily_cost_summary(
    ev: DataFrame, since, tenant: str | None = None, approx: bool = False
) -> DataFrame:
    """Per day, tenant and job type: counts, hours, cost, median and p95 duration."""
    rows = scan_events(ev, since, tenant).withColumn("run_date", F.to_date("started_at"))
    grouped = summarize(
        rows,
        ["run_date", "tenant_id", "job_type"],
        {**counts(), **amounts("gpu_hours", "cpu_hours", "cost_usd"), **known("cost_usd")},
        value="duration_seconds", at=(0.5, 0.95), approx=approx,
    )
    return grouped.select(
        "run_date", "tenant_id", "job_type",
        F.col("jobs_n").alias("total_jobs"),
        F.col("ok_n").alias("succeeded"),
        F.col("failed_n").alias("failed"),
        rnd(pct("ok_n", "jobs_n"), 2).alias("success_rate_pct"),
        total("gpu_hours", 4).alias("total_gpu_hours"),
        total("cpu_hours", 4).alias("total_cpu_hours"),
        total("cost_usd", 4).alias("total_cost_usd"),
        mean("cost_usd", 6).alias("avg_cost_per_job"),
        hours(F.element_at("q", 1), 3).alias("p50_hours"),
        hours(F.element_at("q", 2), 3).alias("p95_hours"),
    ).orderBy(F.col("run_date").desc_nulls_last(), "job_type", "tenant_id")


def latency_by_framework(
    ev: DataFrame, since, tenant: str | None = None, min_jobs: int = 5, approx: bool = False
) -> DataFrame:
    """Duration percentiles of finished jobs per tenant, framework and job type."""
    rows = scan_events(ev, since, tenant).filter(F.col("status").isin(*TERMINAL))
    seconds = {"seconds_sum": F.col("duration_seconds").cast("bigint")}
    grouped = summarize(
        rows,
        ["tenant_id", "framework", "job_type"],
        {**counts(), **seconds, **known("duration_seconds"), **amounts("cost_usd"), **known("cost_usd")},
        value="duration_seconds", at=(0.5, 0.95, 0.99), approx=approx,
    ).filter(F.col("jobs_n") >= min_jobs)
    return grouped.select(
        "tenant_id", "framework", "job_type",
        F.col("jobs_n").alias("jobs"),
        hours(F.element_at("q", 1), 3).alias("p50_hours"),
        hours(F.element_at("q", 2), 3).alias("p95_hours"),
        hours(F.element_at("q", 3), 3).alias("p99_hours"),
        rnd(ratio("seconds_sum", "duration_seconds_n") / F.lit(3600.0), 3).alias("avg_hours"),
        mean("cost_usd", 6).alias("avg_cost_usd"),
    ).orderBy(F.col("p95_hours").desc_nulls_last(), "tenant_id", "framework", "job_type")


def weekly_gpu_spend(
    ev: DataFrame, since, tenant: str | None = None, short_seconds: int = 300
) -> DataFrame:
    """Accelerator cost and short-job share per week, tenant, machine and accelerator."""
    rows = scan_events(ev, since, tenant).filter(F.col("gpu_count") > 0)
    grouped = summarize(
        rows.withColumn("week_start", week_start("started_at")),
        ["week_start", "tenant_id", "machine_type", "gpu_type"],
        {
            **counts(),
            **amounts("gpu_hours", "cost_usd"),
            **known("cost_usd"),
            "short_n": hit(F.col("duration_seconds") < short_seconds),
        },
    )
    return grouped.select(
        "week_start", "tenant_id", "machine_type", "gpu_type",
        F.col("jobs_n").alias("gpu_jobs"),
        total("gpu_hours", 3).alias("total_gpu_hours"),
        total("cost_usd", 4).alias("total_cost_usd"),
        mean("cost_usd", 6).alias("avg_cost_per_job"),
        F.col("short_n").alias("sub_5min_jobs"),
        rnd(pct("short_n", "jobs_n"), 1).alias("waste_rate_pct"),
    ).orderBy(
        F.col("week_start").desc_nulls_last(), F.col("total_gpu_hours").desc_nulls_last(),
        "tenant_id", "machine_type",
    )


def job_success_rate(ev: DataFrame) -> DataFrame:
    """View: success share and cost per tenant, day and job type."""
    grouped = summarize(
        ev.withColumn("day", F.to_date("started_at")),
        ["tenant_id", "day", "job_type"], {**counts(), **amounts("cost_usd")},
    )
    return grouped.select(
        "tenant_id", "day", "job_type",
        F.col("jobs_n").alias("total_jobs"),
        F.col("ok_n").alias("succeeded"),
        F.col("failed_n").alias("failed"),
        rnd(pct("ok_n", "jobs_n"), 2).alias("success_rate_pct"),
        total("cost_usd", 4).alias("total_cost_usd"),
    )


def gpu_spend_weekly(ev: DataFrame) -> DataFrame:
    """View: accelerator hours, cost and mean accelerator count per tenant and week."""
    rows = ev.filter(F.col("gpu_count") > 0).withColumn("week_start", week_start("started_at"))
    grouped = summarize(
        rows, ["tenant_id", "week_start"],
        {
            "jobs_n": F.lit(1).cast("bigint"),
            **amounts("gpu_hours", "cost_usd"),
            "gpus": F.col("gpu_count").cast("bigint"),
        },
    )
    return grouped.select(
        "tenant_id", "week_start",
        from_units("gpu_hours_u").alias("total_gpu_hours"),
        from_units("cost_usd_u").alias("total_cost_usd"),
        ratio("gpus", "jobs_n").alias("avg_gpu_count"),
    ).orderBy("tenant_id", "week_start")


def create_views(ev: DataFrame) -> None:
    """Register both views by name in the session of ``ev``."""
    job_success_rate(ev).createOrReplaceTempView("v_job_success_rate")
    gpu_spend_weekly(ev).createOrReplaceTempView("v_gpu_spend_weekly")


# The same reports as parameterised SQL, for users who work in SQL. They read
# the views `job_events` and `incidents` of the session. Rounding is the
# recipe of functions.numeric, percentiles go over a per-second histogram.
REPORT_SQL = {
    "daily_cost_summary": """
        WITH histogram AS (
          SELECT to_date(started_at) AS run_date, tenant_id, job_type, duration_seconds,
                 count(*) AS n, count_if(status = 'SUCCEEDED') AS ok,
                 count_if(status = 'FAILED') AS failed,
                 sum(floor(nanvl(gpu_hours, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) AS gpu_u,
                 sum(floor(nanvl(cpu_hours, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) AS cpu_u,
                 sum(floor(nanvl(cost_usd, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) AS cost_u, count(nanvl(cost_usd, CAST(NULL AS DOUBLE))) AS cost_n
          FROM job_events
          WHERE tenant_id = :tenant_id AND started_at >= CAST(:since_date AS TIMESTAMP_NTZ)
          GROUP BY ALL),
        grouped AS (
          SELECT run_date, tenant_id, job_type, sum(n) AS n, sum(ok) AS ok, sum(failed) AS failed,
                 sum(gpu_u) / 1e6D AS gpu, sum(cpu_u) / 1e6D AS cpu, sum(cost_u) / 1e6D AS cost,
                 sum(cost_n) AS cost_n, percentile(duration_seconds, array(0.5D, 0.95D), n) AS q
          FROM histogram GROUP BY run_date, tenant_id, job_type)
        SELECT run_date, tenant_id, job_type, n AS total_jobs, ok AS succeeded, failed,
               floor(100e0D * ok / n * 1e2D + 0.5D) / 1e2D AS success_rate_pct,
               floor(gpu * 1e4D + 0.5D) / 1e4D AS total_gpu_hours,
               floor(cpu * 1e4D + 0.5D) / 1e4D AS total_cpu_hours,
               floor(cost * 1e4D + 0.5D) / 1e4D AS total_cost_usd,
               floor(try_divide(cost, cost_n) * 1e6D + 0.5D) / 1e6D AS avg_cost_per_job,
               floor(floor(q[0] * 1e2D + 0.5D) / 1e2D / 3600D * 1e3D + 0.5D) / 1e3D AS p50_hours,
               floor(floor(q[1] * 1e2D + 0.5D) / 1e2D / 3600D * 1e3D + 0.5D) / 1e3D AS p95_hours
        FROM grouped ORDER BY run_date DESC NULLS LAST, job_type""",
    "latency_by_framework": """
        WITH histogram AS (
          SELECT tenant_id, framework, job_type, duration_seconds, count(*) AS n,
                 count(duration_seconds) AS known,
                 sum(CAST(duration_seconds AS BIGINT)) AS seconds,
                 sum(floor(nanvl(cost_usd, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) AS cost_u, count(nanvl(cost_usd, CAST(NULL AS DOUBLE))) AS cost_n
          FROM job_events
          WHERE tenant_id = :tenant_id AND started_at >= CAST(:since_date AS TIMESTAMP_NTZ)
            AND status IN ('SUCCEEDED', 'FAILED')
          GROUP BY ALL),
        grouped AS (
          SELECT tenant_id, framework, job_type, sum(n) AS jobs, sum(known) AS known,
                 sum(seconds) AS seconds, sum(cost_u) / 1e6D AS cost, sum(cost_n) AS cost_n,
                 percentile(duration_seconds, array(0.5D, 0.95D, 0.99D), n) AS q
          FROM histogram GROUP BY tenant_id, framework, job_type HAVING sum(n) >= 5)
        SELECT tenant_id, framework, job_type, jobs,
               floor(floor(q[0] * 1e2D + 0.5D) / 1e2D / 3600D * 1e3D + 0.5D) / 1e3D AS p50_hours,
               floor(floor(q[1] * 1e2D + 0.5D) / 1e2D / 3600D * 1e3D + 0.5D) / 1e3D AS p95_hours,
               floor(floor(q[2] * 1e2D + 0.5D) / 1e2D / 3600D * 1e3D + 0.5D) / 1e3D AS p99_hours,
               floor(try_divide(CAST(seconds AS DOUBLE), known) / 3600D * 1e3D + 0.5D) / 1e3D
                 AS avg_hours,
               floor(try_divide(cost, cost_n) * 1e6D + 0.5D) / 1e6D AS avg_cost_usd
        FROM grouped ORDER BY p95_hours DESC NULLS LAST, framework, job_type""",
    "weekly_gpu_spend": """
        WITH grouped AS (
          SELECT trunc(to_date(started_at), 'week') AS week_start, tenant_id, machine_type, gpu_type,
                 count(*) AS gpu_jobs, sum(floor(nanvl(gpu_hours, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) / 1e6D AS gpu,
                 sum(floor(nanvl(cost_usd, CAST(NULL AS DOUBLE)) * 1e6D + 0.5D)) / 1e6D AS cost, count(nanvl(cost_usd, CAST(NULL AS DOUBLE))) AS cost_n,
                 count_if(duration_seconds < 300) AS sub_5min_jobs
          FROM job_events
          WHERE tenant_id = :tenant_id AND started_at >= CAST(:since_date AS TIMESTAMP_NTZ)
            AND gpu_count > 0
          GROUP BY ALL)
        SELECT week_start, tenant_id, machine_type, gpu_type, gpu_jobs,
               floor(gpu * 1e3D + 0.5D) / 1e3D AS total_gpu_hours,
               floor(cost * 1e4D + 0.5D) / 1e4D AS total_cost_usd,
               floor(try_divide(cost, cost_n) * 1e6D + 0.5D) / 1e6D AS avg_cost_per_job,
               sub_5min_jobs,
               floor(100e0D * sub_5min_jobs / gpu_jobs * 10D + 0.5D) / 10D AS waste_rate_pct
        FROM grouped ORDER BY week_start DESC NULLS LAST, total_gpu_hours DESC NULLS LAST""",
    "open_incidents_ranked": """
        SELECT incident_id, tenant_id, job_id, incident_type, severity, title, description,
               metric_value, threshold_value, recommended_action, detected_at,
               timestampdiff(MINUTE, date_trunc('MINUTE', detected_at),
                             date_trunc('MINUTE', CAST(:as_of AS TIMESTAMP_NTZ))) AS age_minutes
        FROM incidents WHERE status = 'OPEN' AND tenant_id = :tenant_id
        ORDER BY CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1
                               WHEN 'MEDIUM' THEN 2 ELSE 3 END,
                 detected_at DESC NULLS LAST, incident_id""",
}


def report_sql(spark: SparkSession, name: str, **args) -> DataFrame:
    """Run a named report with ``tenant_id`` and ``since_date`` (or ``as_of``) bound."""
    return spark.sql(REPORT_SQL[name], args=args)
