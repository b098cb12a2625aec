"""DuckDB SQL for every registered query, written from the rule, not from the Spark code.

Texts name the views of `fixtures` as `{view}`. `R` rounds, `S` sums money,
`P` is a snapped percentile: the number recipe both engines share.
"""

from __future__ import annotations

from fixtures import oracle

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
SINCE = "started_at >= TIMESTAMP '2024-01-01 00:00:00'"
DAY = "started_at >= TIMESTAMP '2024-01-30 00:00:00' AND started_at < TIMESTAMP '2024-01-31 00:00:00'"
WEEK = "started_at >= TIMESTAMP '2024-01-24 00:00:00' AND started_at < TIMESTAMP '2024-01-31 00:00:00'"


def R(x: str, d: int) -> str:
    return f"(floor(({x}) * 1e{d} + 0.5e0) / 1e{d})"


def S(c: str, where: str | None = None) -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum(CAST({c} AS DECIMAL(18,6))){tail} AS DOUBLE)"


def P(p: float, c: str = "duration_seconds", where: str | None = None) -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return R(f"percentile_cont({p}) WITHIN GROUP (ORDER BY {c}){tail}", 2)


def H(p: float, d: int) -> str:
    return R(f"{P(p)} / 3600e0", d)


def N(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def W(span: str, c: str = "started_at") -> str:
    return f"({c} > {NOW} - INTERVAL {span} AND {c} <= {NOW})"


OK, BAD = "status = 'SUCCEEDED'", "status = 'FAILED'"
DONE = "status IN ('SUCCEEDED', 'FAILED')"
RATE = f"100e0 * {N(OK)} / nullif(count(*), 0)"
WEEK_START = "CAST(date_trunc('week', started_at) AS DATE)"

# --- shared pieces -------------------------------------------------------------

_HEALTH = f"""
    m AS (
      SELECT t.tenant_id, t.budget_weekly / 7e0 AS daily,
             count(e.event_id) FILTER (WHERE {W("'1' HOUR")}) AS n1,
             count(e.event_id) FILTER (WHERE {W("'1' HOUR")} AND {OK}) AS ok1,
             count(e.event_id) FILTER (WHERE {W("'24' HOUR")}) AS n24,
             count(e.event_id) FILTER (WHERE {W("'24' HOUR")} AND {OK}) AS ok24,
             {P(0.95, where=W("'24' HOUR") + " AND " + DONE)} AS p95,
             coalesce({S("cost_usd", DAY)}, 0e0) AS spend,
             date_diff('minute', max(ingested_at) FILTER (WHERE ingested_at <= {NOW}), {NOW}) AS age,
             count(e.event_id) FILTER (WHERE {W("'24' HOUR")} AND gpu_count > 0) AS gpu_n,
             count(e.event_id) FILTER (WHERE {W("'24' HOUR")} AND gpu_count > 0
                                       AND duration_seconds < 300) AS gpu_short
      FROM {{tenants}} t LEFT JOIN {{job_events}} e ON e.tenant_id = t.tenant_id GROUP BY 1, 2),
    checks AS (
      SELECT tenant_id, 'success_rate_1h' AS check_name,
             n1 = 0 OR 100e0 * ok1 / n1 >= 85 AS passed,
             CASE WHEN n1 = 0 THEN 'LOW' WHEN 100e0 * ok1 / n1 < 70 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
             {R("100e0 * ok1 / nullif(n1, 0)", 2)} AS metric,
             CASE WHEN n1 > 0 THEN 85e0 END AS threshold FROM m
      UNION ALL
      SELECT tenant_id, 'success_rate_24h', n24 = 0 OR 100e0 * ok24 / n24 >= 90,
             CASE WHEN n24 = 0 THEN 'LOW' ELSE 'MEDIUM' END,
             {R("100e0 * ok24 / nullif(n24, 0)", 2)}, CASE WHEN n24 > 0 THEN 90e0 END FROM m
      UNION ALL
      SELECT tenant_id, 'p95_latency', p95 IS NULL OR p95 <= 10800,
             CASE WHEN p95 IS NULL THEN 'LOW' WHEN p95 > 16200 THEN 'HIGH' ELSE 'MEDIUM' END,
             {R("p95", 1)}, CASE WHEN p95 IS NOT NULL THEN 10800e0 END FROM m
      UNION ALL
      SELECT tenant_id, 'daily_budget', spend <= daily * 1.2e0,
             CASE WHEN 100e0 * spend / daily > 150 THEN 'CRITICAL'
                  WHEN 100e0 * spend / daily > 120 THEN 'HIGH' ELSE 'MEDIUM' END,
             {R("spend", 4)}, {R("daily * 1.2e0", 4)} FROM m
      UNION ALL
      SELECT tenant_id, 'pipeline_staleness', age IS NOT NULL AND age <= 30,
             CASE WHEN age IS NULL OR age > 60 THEN 'HIGH' ELSE 'MEDIUM' END,
             CAST(age AS DOUBLE), CASE WHEN age IS NOT NULL THEN 30e0 END FROM m
      UNION ALL
      SELECT tenant_id, 'gpu_cost_efficiency', gpu_n = 0 OR 100e0 * gpu_short / gpu_n < 30,
             CASE WHEN gpu_n = 0 THEN 'LOW' ELSE 'MEDIUM' END,
             {R("100e0 * gpu_short / nullif(gpu_n, 0)", 1)}, CASE WHEN gpu_n > 0 THEN 30e0 END FROM m)
"""

_SPIKES = f"""
    stats AS (
      SELECT tenant_id, job_type, machine_type, {S("cost_usd")} / count(cost_usd) AS mean,
             stddev_samp(cost_usd) AS sd
      FROM {{job_events}} WHERE {W("'7' DAY")} GROUP BY 1, 2, 3 HAVING count(*) >= 10),
    spikes AS (
      SELECT e.tenant_id, e.event_id, e.job_id, e.cost_usd, s.mean, s.sd,
             (e.cost_usd - s.mean) / nullif(s.sd, 0) AS z
      FROM {{job_events}} e JOIN stats s USING (tenant_id, job_type, machine_type)
      WHERE {W("'24' HOUR")} AND (e.cost_usd - s.mean) / nullif(s.sd, 0) > 3
      QUALIFY row_number() OVER (PARTITION BY e.tenant_id ORDER BY z DESC, e.cost_usd DESC, e.event_id) <= 20)
"""
_FENCE = f"""
    fence AS (
      SELECT tenant_id, q1, q3, q3 + 2.5e0 * (q3 - q1) AS fence FROM (
        SELECT tenant_id, percentile_cont(0.25) WITHIN GROUP (ORDER BY duration_seconds) AS q1,
               percentile_cont(0.75) WITHIN GROUP (ORDER BY duration_seconds) AS q3
        FROM {{job_events}} WHERE {W("'7' DAY")} GROUP BY 1))
"""
_OUTLIERS = _FENCE + f""",
    outliers AS (
      SELECT e.tenant_id, e.event_id, e.job_id, e.duration_seconds, f.fence
      FROM {{job_events}} e JOIN fence f USING (tenant_id)
      WHERE {W("'24' HOUR")} AND e.duration_seconds > f.fence
      QUALIFY row_number() OVER (PARTITION BY e.tenant_id ORDER BY e.duration_seconds DESC, e.event_id) <= 10)
"""
_RATES = f"""
    rates AS (
      SELECT *, 100e0 * recent_failed / nullif(recent_jobs, 0) AS recent_rate,
             100e0 * baseline_failed / nullif(baseline_jobs, 0) AS baseline_rate
      FROM (SELECT tenant_id, {N(f"started_at > {NOW} - INTERVAL '1' HOUR")} AS recent_jobs,
                   {N(f"started_at > {NOW} - INTERVAL '1' HOUR AND {BAD}")} AS recent_failed,
                   {N(f"started_at < {NOW} - INTERVAL '1' HOUR")} AS baseline_jobs,
                   {N(f"started_at < {NOW} - INTERVAL '1' HOUR AND {BAD}")} AS baseline_failed
            FROM {{job_events}} WHERE {W("'7' DAY")} GROUP BY 1))
"""
_WASTE = f"""
    waste AS (
      SELECT tenant_id, count(*) AS gpu_jobs, {N("duration_seconds < 300")} AS short_jobs,
             100e0 * {N("duration_seconds < 300")} / count(*) AS waste_pct,
             coalesce({S("cost_usd", "duration_seconds < 300")}
                      / nullif(count(cost_usd) FILTER (WHERE duration_seconds < 300), 0), 0e0) AS avg_cost
      FROM {{job_events}} WHERE {W("'24' HOUR")} AND gpu_count > 0 GROUP BY 1)
"""
_ANOMALIES = f"""{_SPIKES}, {_OUTLIERS}, {_RATES}, {_WASTE},
    anomalies AS (
      SELECT tenant_id, job_id, 'COST_SPIKE' AS anomaly_type,
             CASE WHEN z > 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
             {R("cost_usd", 6)} AS metric_value, {R("mean + 3e0 * sd", 6)} AS threshold_value FROM spikes
      UNION ALL
      SELECT tenant_id, job_id, 'DURATION_OUTLIER', 'MEDIUM', CAST(duration_seconds AS DOUBLE),
             {R("fence", 1)} FROM outliers
      UNION ALL
      SELECT tenant_id, NULL, 'FAILURE_BURST',
             CASE WHEN recent_rate - baseline_rate > 40 THEN 'CRITICAL' ELSE 'HIGH' END,
             {R("recent_rate", 2)}, {R("baseline_rate + 20e0", 2)}
      FROM rates WHERE recent_rate - baseline_rate > 20
      UNION ALL
      SELECT tenant_id, NULL, 'GPU_WASTE_PATTERN', 'MEDIUM', {R("waste_pct", 1)}, 20e0
      FROM waste WHERE gpu_jobs >= 10 AND waste_pct >= 20)
"""
_RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END"
_SNAPSHOT = f"""
    snap AS (
      SELECT t.tenant_id, coalesce(i.n, 0) AS incidents_24h, coalesce(i.v, 0e0) AS incident_metric_sum,
             coalesce(j.n, 0) AS jobs_24h, coalesce(j.c, 0e0) AS cost_24h
      FROM {{tenants}} t
      LEFT JOIN (SELECT tenant_id, count(*) AS n, {S("metric_value")} AS v FROM {{incidents}}
                 WHERE {W("'24' HOUR", "detected_at")} GROUP BY 1) i USING (tenant_id)
      LEFT JOIN (SELECT tenant_id, count(*) AS n, {S("cost_usd")} AS c FROM {{job_events}}
                 WHERE {W("'24' HOUR")} GROUP BY 1) j USING (tenant_id))
"""
_BUDGET = f"""
    budget AS (
      SELECT t.tenant_id, t.budget_weekly, coalesce(s.spend, 0e0) AS spend,
             100e0 * coalesce(s.spend, 0e0) / t.budget_weekly AS used
      FROM {{tenants}} t LEFT JOIN (
        SELECT tenant_id, {S("cost_usd")} AS spend FROM {{job_events}}
        WHERE started_at >= TIMESTAMP '2024-01-23 00:00:00' AND started_at <= {NOW} GROUP BY 1) s
      USING (tenant_id))
"""


def _check(name: str) -> str:
    return f"WITH {_HEALTH} SELECT * FROM checks WHERE check_name = '{name}'"


_TEXTS: dict[str, str] = {
    # --- scans, decoding, loading ---------------------------------------------
    "job_events_scan": "SELECT * FROM {job_events}",
    "json_decode": """
        SELECT event_id, tenant_id, job_type, status, gpu_count, started_at, completed_at,
               duration_seconds, cost_usd
        FROM {raw_job_events} WHERE status <> 'RUNNING'""",
    "rejected_lines": """
        SELECT 'malformed record' AS reason, CAST(count(*) AS BIGINT) AS lines
        FROM {raw_job_events} WHERE status = 'RUNNING'""",
    "defaults_applied": f"""
        SELECT event_id, gpu_count, replica_count, gpu_hours,
               CASE WHEN status = 'RUNNING' THEN 0e0 ELSE cpu_hours END AS cpu_hours,
               CASE WHEN status = 'FAILED' THEN 0e0 ELSE cost_usd END AS cost_usd,
               CASE WHEN job_type = 'TRAINING' THEN {NOW} ELSE ingested_at END AS ingested_at
        FROM {{job_events}}""",
    "dedup_events": """
        SELECT DISTINCT event_id, tenant_id, job_id, status, started_at, cost_usd
        FROM {raw_job_events} r WHERE NOT EXISTS (
          SELECT 1 FROM {job_events} t
          WHERE t.started_at < TIMESTAMP '2024-01-16 00:00:00' AND t.event_id = r.event_id)""",
    "publish_payload": """
        SELECT tenant_id AS key,
               '{"event_id":"' || event_id || '","tenant_id":"' || tenant_id || '","status":"' || status
               || '","gpu_type":' || coalesce('"' || gpu_type || '"', 'null')
               || ',"duration_seconds":' || duration_seconds || '}' AS value
        FROM {job_events}""",
    "tenant_dim": """
        SELECT t.tenant_id, t.display_name, t.project_id, t.region, t.budget_weekly, t.sla_p95_hours,
               count(e.event_id) AS jobs
        FROM {tenants} t LEFT JOIN {job_events} e ON e.tenant_id = t.tenant_id GROUP BY ALL""",
    "cost_enrichment": """
        SELECT event_id, gpu_type, gpu_count, gpu_hours, cpu_hours, cost_usd FROM {job_events}""",
    # --- filters, scalar expressions ------------------------------------------
    "filter_tenant": """
        SELECT event_id, tenant_id, job_type, status, started_at, cost_usd FROM {job_events}
        WHERE tenant_id = 'client_demo'""",
    "filter_since": """
        SELECT event_id, tenant_id, job_type, status, started_at, cost_usd FROM {job_events}
        WHERE started_at >= TIMESTAMP '2024-01-15 00:00:00'""",
    "trailing_windows": f"""
        SELECT tenant_id, {N(W("'20' MINUTE", "ingested_at"))} AS ingested_20min,
               {N(W("'30' MINUTE", "ingested_at"))} AS ingested_30min,
               {N(W("'1' HOUR"))} AS started_1h, {N(W("'24' HOUR"))} AS started_24h,
               {N(W("'7' DAY"))} AS started_7d
        FROM {{job_events}} GROUP BY 1""",
    "date_functions": f"""
        SELECT event_id, CAST(started_at AS DATE) AS run_date, {WEEK_START} AS week_start,
               CAST(extract(dow FROM started_at) AS BIGINT) AS weekday,
               CAST(extract(hour FROM started_at) AS BIGINT) AS hour,
               date_diff('minute', started_at, {NOW}) AS age_minutes,
               started_at + INTERVAL '1' HOUR AS plus_one_hour
        FROM {{job_events}}""",
    "severity_tiers": f"""
        WITH d AS (
          SELECT e.tenant_id, CAST(started_at AS DATE) AS day, {RATE} AS rate,
                 100e0 * {S("cost_usd")} / (t.budget_weekly / 7e0) AS used
          FROM {{job_events}} e JOIN {{tenants}} t ON t.tenant_id = e.tenant_id WHERE {SINCE}
          GROUP BY 1, 2, t.budget_weekly)
        SELECT tenant_id, day, {R("rate", 2)} AS success_pct,
               CASE WHEN rate < 70 THEN 'HIGH' ELSE 'MEDIUM' END AS success_severity,
               {R("used", 2)} AS spend_pct,
               CASE WHEN used > 150 THEN 'CRITICAL' WHEN used > 120 THEN 'HIGH' ELSE 'MEDIUM' END
                 AS spend_severity,
               CASE WHEN used < 80 THEN 'On track' WHEN used < 100 THEN 'At risk'
                    ELSE 'Over budget' END AS spend_label
        FROM d""",
    # --- reports ----------------------------------------------------------------
    "daily_cost_summary": f"""
        SELECT CAST(started_at AS DATE) AS run_date, tenant_id, job_type, count(*) AS total_jobs,
               {N(OK)} AS succeeded, {N(BAD)} AS failed, {R(RATE, 2)} AS success_rate_pct,
               {R(S("gpu_hours"), 4)} AS total_gpu_hours, {R(S("cpu_hours"), 4)} AS total_cpu_hours,
               {R(S("cost_usd"), 4)} AS total_cost_usd,
               {R(S("cost_usd") + " / count(cost_usd)", 6)} AS avg_cost_per_job,
               {H(0.5, 3)} AS p50_hours, {H(0.95, 3)} AS p95_hours
        FROM {{job_events}} WHERE {SINCE} GROUP BY 1, 2, 3""",
    "latency_by_framework": f"""
        SELECT tenant_id, framework, job_type, count(*) AS jobs, {H(0.5, 3)} AS p50_hours,
               {H(0.95, 3)} AS p95_hours, {H(0.99, 3)} AS p99_hours,
               {R("avg(duration_seconds) / 3600e0", 3)} AS avg_hours,
               {R(S("cost_usd") + " / count(cost_usd)", 6)} AS avg_cost_usd
        FROM {{job_events}} WHERE {SINCE} AND {DONE} GROUP BY 1, 2, 3 HAVING count(*) >= 5""",
    "weekly_gpu_spend": f"""
        SELECT {WEEK_START} AS week_start, tenant_id, machine_type, gpu_type, count(*) AS gpu_jobs,
               {R(S("gpu_hours"), 3)} AS total_gpu_hours, {R(S("cost_usd"), 4)} AS total_cost_usd,
               {R(S("cost_usd") + " / count(cost_usd)", 6)} AS avg_cost_per_job,
               {N("duration_seconds < 300")} AS sub_5min_jobs,
               {R("100e0 * " + N("duration_seconds < 300") + " / count(*)", 1)} AS waste_rate_pct
        FROM {{job_events}} WHERE {SINCE} AND gpu_count > 0 GROUP BY 1, 2, 3, 4""",
    "job_success_rate": f"""
        SELECT tenant_id, CAST(started_at AS DATE) AS day, job_type, count(*) AS total_jobs,
               {N(OK)} AS succeeded, {N(BAD)} AS failed, {R(RATE, 2)} AS success_rate_pct,
               {R(S("cost_usd"), 4)} AS total_cost_usd
        FROM {{job_events}} GROUP BY 1, 2, 3""",
    "gpu_spend_weekly": f"""
        SELECT tenant_id, {WEEK_START} AS week_start, {S("gpu_hours")} AS total_gpu_hours,
               {S("cost_usd")} AS total_cost_usd, avg(gpu_count) AS avg_gpu_count
        FROM {{job_events}} WHERE gpu_count > 0 GROUP BY 1, 2""",
    "daily_metrics": f"""
        WITH d AS (
          SELECT CAST(started_at AS DATE) AS metric_date, e.tenant_id, job_type, t.budget_weekly,
                 count(*) AS total_jobs, {N(OK)} AS succeeded_jobs, {N(BAD)} AS failed_jobs,
                 {S("gpu_hours")} AS g, {S("cpu_hours")} AS c, {S("cost_usd")} AS cost,
                 avg(duration_seconds) AS a, {P(0.95)} AS p
          FROM {{job_events}} e JOIN {{tenants}} t ON t.tenant_id = e.tenant_id GROUP BY 1, 2, 3, 4)
        SELECT metric_date, tenant_id, job_type, total_jobs, succeeded_jobs, failed_jobs,
               {R("g", 4)} AS total_gpu_hours, {R("c", 4)} AS total_cpu_hours,
               {R("cost", 4)} AS total_cost_usd, {R("a", 1)} AS avg_duration_sec,
               {R("p", 1)} AS p95_duration_sec, budget_weekly / 7e0 AS budget_threshold,
               cost > budget_weekly / 7e0 * 1.2e0 AS is_over_budget, {NOW} AS computed_at,
               sum(cost) OVER (PARTITION BY metric_date, tenant_id) > budget_weekly / 7e0 * 1.2e0
                 AS tenant_day_over_budget
        FROM d""",
    "technical_kpis": f"""
        SELECT t.tenant_id, coalesce(j.n, 0) AS total_jobs, coalesce(j.r, 0e0) AS success_rate,
               coalesce(j.p, 0e0) AS p95_hours, coalesce(j.f, 0) AS total_failures,
               coalesce(i.n, 0) AS open_incidents
        FROM {{tenants}} t
        LEFT JOIN (SELECT tenant_id, count(*) AS n, {R(RATE, 1)} AS r, {H(0.95, 2)} AS p, {N(BAD)} AS f
                   FROM {{job_events}} WHERE {SINCE} GROUP BY 1) j USING (tenant_id)
        LEFT JOIN (SELECT tenant_id, count(*) AS n FROM {{incidents}} WHERE status = 'OPEN'
                   GROUP BY 1) i USING (tenant_id)""",
    "open_incidents": f"""
        SELECT incident_id, tenant_id, job_id, incident_type, severity, metric_value, threshold_value,
               detected_at, date_diff('minute', detected_at, {NOW}) AS age_minutes
        FROM {{incidents}} WHERE status = 'OPEN'""",
    "open_incidents_top20": f"""
        SELECT incident_id, tenant_id, job_id, incident_type, severity, metric_value, threshold_value,
               detected_at, date_diff('minute', detected_at, {NOW}) AS age_minutes
        FROM {{incidents}} WHERE status = 'OPEN'
        QUALIFY row_number() OVER (PARTITION BY tenant_id
          ORDER BY {_RANK}, detected_at DESC, incident_id) <= 20""",
    "volume_trend": f"""
        SELECT tenant_id, CAST(started_at AS DATE) AS day, count(*) AS total_jobs,
               {R(RATE, 1)} AS success_rate
        FROM {{job_events}} WHERE {SINCE} GROUP BY 1, 2""",
    "latency_box": f"""
        SELECT tenant_id, job_type, count(*) AS jobs,
               {R("min(duration_seconds) / 3600e0", 3)} AS min_hours, {H(0.25, 3)} AS q1_hours,
               {H(0.5, 3)} AS median_hours, {H(0.75, 3)} AS q3_hours,
               {R("max(duration_seconds) / 3600e0", 3)} AS max_hours
        FROM {{job_events}} WHERE {SINCE} AND {DONE} GROUP BY 1, 2""",
    "failure_heatmap": f"""
        SELECT tenant_id, CAST(extract(dow FROM started_at) AS BIGINT) AS weekday,
               CAST(extract(hour FROM started_at) AS BIGINT) AS hour, count(*) AS failures
        FROM {{job_events}} WHERE {SINCE} AND {BAD} GROUP BY 1, 2, 3""",
    "failure_heatmap_pivot": f"""
        SELECT tenant_id, strftime(min(started_at), '%a') AS weekday_name,
               {", ".join(N(f"extract(hour FROM started_at) = {h}") + f" AS h{h:02d}" for h in range(24))}
        FROM {{job_events}} WHERE {SINCE} AND {BAD} GROUP BY tenant_id, extract(dow FROM started_at)""",
    "budget_status": f"""
        WITH {_BUDGET}
        SELECT tenant_id, budget_weekly, {R("spend", 4)} AS week_spend, {R("used", 2)} AS pct_used,
               {R("greatest(budget_weekly - spend, 0e0)", 4)} AS remaining,
               CASE WHEN used < 80 THEN 'On track' WHEN used < 100 THEN 'At risk'
                    ELSE 'Over budget' END AS budget_status
        FROM budget""",
    "spend_projection": f"""
        WITH s AS (
          SELECT t.tenant_id, t.budget_weekly, coalesce(x.c, 0e0) AS c FROM {{tenants}} t LEFT JOIN (
            SELECT tenant_id, {S("cost_usd")} AS c FROM {{job_events}}
            WHERE {SINCE} AND started_at <= {NOW} GROUP BY 1) x USING (tenant_id))
        SELECT tenant_id, CAST(29 AS BIGINT) AS days_in_range, {R("c", 4)} AS total_spend,
               {R("c / 29e0", 4)} AS daily_average, {R("budget_weekly / 7e0", 4)} AS daily_budget,
               {R("c / 29e0 * 30e0", 2)} AS projected_30d,
               {R("budget_weekly / 7e0 * 30e0", 2)} AS monthly_budget,
               {R("100e0 * (c / 29e0 * 30e0) / (budget_weekly / 7e0 * 30e0)", 2)} AS pct_of_budget,
               {R("c / 29e0 * 30e0 - budget_weekly / 7e0 * 30e0", 2)} AS difference
        FROM s""",
    "weekly_spend_vs_budget": f"""
        SELECT e.tenant_id, {WEEK_START} AS week_start, {R(S("cost_usd"), 2)} AS total_cost,
               any_value(t.budget_weekly) AS weekly_budget
        FROM {{job_events}} e JOIN {{tenants}} t ON t.tenant_id = e.tenant_id WHERE {SINCE} GROUP BY 1, 2""",
    "spend_by_job_type": f"""
        SELECT tenant_id, job_type, {R(S("cost_usd"), 4)} AS cost FROM {{job_events}}
        WHERE {SINCE} GROUP BY 1, 2""",
    "resource_cost_split": f"""
        SELECT tenant_id, CASE WHEN gpu_count > 0 THEN 'GPU' ELSE 'CPU-only' END AS resource_type,
               job_type, {R(S("cost_usd"), 4)} AS total_cost, count(*) AS job_count
        FROM {{job_events}} WHERE {SINCE} GROUP BY 1, 2, 3""",
    "daily_spend": f"""
        SELECT e.tenant_id, CAST(started_at AS DATE) AS date, count(*) AS jobs, {N(OK)} AS succeeded,
               {N(BAD)} AS failed, {R(S("gpu_hours"), 2)} AS gpu_hours,
               {R(S("cpu_hours"), 2)} AS cpu_hours, {R(S("cost_usd"), 4)} AS total_cost_usd,
               {R("any_value(t.budget_weekly) / 7e0", 2)} AS daily_budget,
               {R("100e0 * " + S("cost_usd") + " / (any_value(t.budget_weekly) / 7e0)", 1)} AS pct_of_budget
        FROM {{job_events}} e JOIN {{tenants}} t ON t.tenant_id = e.tenant_id WHERE {SINCE} GROUP BY 1, 2""",
    "top_expensive_jobs": f"""
        SELECT tenant_id, event_id, job_name, job_type, machine_type, {R("cost_usd", 4)} AS cost_usd,
               {R("duration_seconds / 3600e0", 2)} AS hours, status, CAST(started_at AS DATE) AS run_date
        FROM {{job_events}} WHERE {SINCE}
        QUALIFY row_number() OVER (PARTITION BY tenant_id
          ORDER BY {{job_events}}.cost_usd DESC, event_id) <= 10""",
    "latency_spikes_rolling": f"""
        WITH s AS (
          SELECT event_id, tenant_id, job_type, started_at, duration_seconds,
                 CAST(floor(epoch(started_at)) AS BIGINT) AS sec FROM {{job_events}}),
        w AS (
          SELECT *, count(*) OVER f AS n, sum(duration_seconds) OVER f AS d FROM s
          WINDOW f AS (PARTITION BY tenant_id, job_type ORDER BY sec
                       RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING))
        SELECT event_id, tenant_id, job_type, started_at, duration_seconds, n AS baseline_jobs,
               {R("CAST(d AS DOUBLE) / n", 2)} AS baseline_seconds,
               {R("duration_seconds / (CAST(d AS DOUBLE) / n)", 3)} AS times_baseline
        FROM w WHERE n > 0 AND duration_seconds > 2.5e0 * (CAST(d AS DOUBLE) / n)""",
    "ingest_window_status": f"""
        SELECT events, failures, failures > 0 AS opens_incident,
               CASE WHEN failures > 3 THEN 'HIGH' WHEN failures > 0 THEN 'MEDIUM' END AS severity
        FROM (SELECT count(*) AS events, {N(BAD)} AS failures FROM {{job_events}}
              WHERE {W("'20' MINUTE", "ingested_at")})""",
    "sla_breaches": f"""
        SELECT e.tenant_id, any_value(sla_p95_hours) AS sla_hours, count(*) AS terminal_jobs,
               {N("duration_seconds > sla_p95_hours * 3600e0")} AS breaching_jobs,
               {R("100e0 * " + N("duration_seconds > sla_p95_hours * 3600e0") + " / count(*)", 2)} AS breach_pct,
               {H(0.95, 3)} AS p95_hours,
               {P(0.95)} > any_value(sla_p95_hours) * 3600e0 AS p95_breached
        FROM {{job_events}} e JOIN {{tenants}} t ON t.tenant_id = e.tenant_id
        WHERE {SINCE} AND {DONE} GROUP BY 1""",
    # --- health -----------------------------------------------------------------
    "success_rate_1h": _check("success_rate_1h"),
    "success_rate_24h": _check("success_rate_24h"),
    "p95_latency": _check("p95_latency"),
    "daily_budget": _check("daily_budget"),
    "staleness": _check("pipeline_staleness"),
    "gpu_efficiency": _check("gpu_cost_efficiency"),
    "health_checks": f"WITH {_HEALTH} SELECT * FROM checks",
    "health_report": f"""
        WITH {_HEALTH}
        SELECT tenant_id, count(*) AS checks_total, {N("passed")} AS checks_passed,
               {N("NOT passed")} AS incidents_opened, {NOW} AS run_at
        FROM checks GROUP BY 1""",
    "health_run_summary": f"""
        WITH {_HEALTH}, {_ANOMALIES}
        SELECT count(DISTINCT tenant_id) AS tenants_checked, {N("NOT passed")} AS incidents_opened,
               (SELECT count(*) FROM anomalies) AS anomalies_flagged
        FROM checks""",
    # --- detectors ----------------------------------------------------------------
    "cost_spikes": f"""
        WITH {_SPIKES}
        SELECT tenant_id, event_id, job_id, CASE WHEN z > 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
               {R("cost_usd", 6)} AS metric_value, {R("mean + 3e0 * sd", 6)} AS threshold_value,
               {R("z", 4)} AS z_score
        FROM spikes""",
    "cost_baseline": f"""
        WITH {_SPIKES}
        SELECT tenant_id, job_type, machine_type, {R("mean", 6)} AS mean_cost, {R("sd", 6)} AS std_cost
        FROM stats""",
    "duration_fence": f"WITH {_FENCE} SELECT tenant_id, q1, q3, fence FROM fence",
    "duration_outliers": f"""
        WITH {_OUTLIERS}
        SELECT tenant_id, event_id, job_id, 'MEDIUM' AS severity,
               CAST(duration_seconds AS DOUBLE) AS metric_value, {R("fence", 1)} AS threshold_value
        FROM outliers""",
    "failure_rates": f"""
        WITH {_RATES}
        SELECT tenant_id, recent_jobs, recent_failed, baseline_jobs, baseline_failed,
               {R("recent_rate", 2)} AS recent_rate, {R("baseline_rate", 2)} AS baseline_rate
        FROM rates""",
    "failure_bursts": f"""
        WITH {_RATES}
        SELECT tenant_id, CASE WHEN recent_rate - baseline_rate > 40 THEN 'CRITICAL' ELSE 'HIGH' END
                 AS severity,
               {R("recent_rate", 2)} AS metric_value, {R("baseline_rate + 20e0", 2)} AS threshold_value
        FROM rates WHERE recent_rate - baseline_rate > 20""",
    "gpu_waste_rates": f"""
        WITH {_WASTE}
        SELECT tenant_id, gpu_jobs, short_jobs, {R("waste_pct", 2)} AS waste_pct,
               {R("avg_cost", 6)} AS avg_wasted_cost
        FROM waste""",
    "gpu_waste_pattern": f"""
        WITH {_WASTE}
        SELECT tenant_id, 'MEDIUM' AS severity, gpu_jobs, short_jobs, {R("waste_pct", 1)} AS metric_value,
               20e0 AS threshold_value, {R("avg_cost", 6)} AS avg_wasted_cost
        FROM waste WHERE gpu_jobs >= 10 AND waste_pct >= 20""",
    "inline_incidents": """
        SELECT tenant_id, job_id, incident_type, severity, metric_value, threshold_value, detected_at
        FROM {incidents}""",
    "all_anomalies": f"WITH {_ANOMALIES} SELECT * FROM anomalies",
    "escalations": f"""
        WITH {_HEALTH}, {_ANOMALIES}
        SELECT tenant_id, upper(check_name) AS incident_type, {NOW} AS detected_at
        FROM checks WHERE NOT passed AND severity = 'CRITICAL'
        UNION ALL
        SELECT tenant_id, anomaly_type, {NOW} FROM anomalies WHERE severity = 'CRITICAL'
        UNION ALL
        SELECT tenant_id, incident_type, detected_at FROM {{raised_incidents}}
        WHERE severity = 'CRITICAL' AND status = 'OPEN' AND {W("'1' HOUR", "detected_at")}""",
    # --- digests --------------------------------------------------------------------
    "digest_snapshot": f"WITH {_SNAPSHOT} SELECT * FROM snap",
    "digest_rows": f"""
        WITH {_SNAPSHOT}, {_BUDGET}
        SELECT tenant_id, DATE '2024-01-30' AS digest_date, 'DAILY' AS period,
               incidents_24h AS incidents_count, cost_24h AS total_cost_usd,
               CASE WHEN used < 80 THEN 'ON_TRACK' WHEN used < 100 THEN 'AT_RISK'
                    ELSE 'OVER_BUDGET' END AS budget_status, {NOW} AS generated_at
        FROM snap JOIN budget USING (tenant_id)""",
    "digest_daily_metrics": f"""
        WITH j AS (
          SELECT tenant_id, {S("cost_usd")} AS wc, {RATE} AS wr,
                 {S("cost_usd", DAY)} AS dc, {N(DAY)} AS dn, {N(DAY + " AND " + OK)} AS dok,
                 {N(DAY + " AND " + BAD)} AS dbad, {P(0.95, where=DAY)} AS p,
                 count(cost_usd) FILTER (WHERE {DAY}) AS dcn,
                 {S("gpu_hours", DAY)} AS dg, {S("cpu_hours", DAY)} AS dcpu
          FROM {{job_events}} WHERE {WEEK} GROUP BY 1),
        i AS (SELECT tenant_id, count(*) AS n FROM {{incidents}} WHERE status = 'OPEN' GROUP BY 1)
        SELECT t.tenant_id, {R("coalesce(dc, 0e0)", 4)} AS spend_today,
               {R("coalesce(wc, 0e0)", 4)} AS spend_week,
               {R("100e0 * coalesce(wc, 0e0) / budget_weekly", 2)} AS budget_pct_used,
               {R("coalesce(wc, 0e0) / 7e0 * 30e0", 2)} AS monthly_projection,
               coalesce(dn, 0) AS total_jobs_today, coalesce(dok, 0) AS succeeded_today,
               coalesce(dbad, 0) AS failed_today,
               {R("100e0 * dok / nullif(dn, 0)", 2)} AS success_rate_today,
               {R("wr", 2)} AS success_rate_7d, {R("p / 3600e0", 2)} AS p95_hours_today,
               {R("dc / nullif(dcn, 0)", 4)} AS avg_cost_today,
               {R("coalesce(dg, 0e0)", 2)} AS gpu_hours_today,
               {R("coalesce(dcpu, 0e0)", 2)} AS cpu_hours_today,
               coalesce(i.n, 0) AS open_incidents
        FROM {{tenants}} t LEFT JOIN j USING (tenant_id) LEFT JOIN i USING (tenant_id)""",
    "digest_weekly_metrics": f"""
        WITH d AS (
          SELECT tenant_id, CAST(started_at AS DATE) AS day, coalesce({S("cost_usd")}, 0e0) AS c
          FROM {{job_events}} WHERE {WEEK} GROUP BY 1, 2),
        peak AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY c DESC, day) = 1),
        trough AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY tenant_id ORDER BY c, day) = 1),
        j AS (
          SELECT tenant_id, {S("cost_usd")} AS c, {S("gpu_hours")} AS g, {S("cpu_hours")} AS cpu,
                 coalesce({S("cost_usd", "gpu_count > 0")}, 0e0) AS gc, count(*) AS n,
                 {N(OK)} AS ok, {N(BAD)} AS bad
          FROM {{job_events}} WHERE {WEEK} GROUP BY 1),
        i AS (
          SELECT tenant_id, count(*) AS n, {N("severity = 'CRITICAL'")} AS crit, {N("severity = 'HIGH'")} AS high
          FROM {{incidents}} WHERE {WEEK.replace("started_at", "detected_at")} GROUP BY 1)
        SELECT t.tenant_id, {R("coalesce(j.c, 0e0)", 4)} AS spend_week,
               {R("100e0 * coalesce(j.c, 0e0) / budget_weekly", 2)} AS budget_pct_used,
               {R("greatest(budget_weekly - coalesce(j.c, 0e0), 0e0)", 4)} AS budget_remaining,
               {R("coalesce(g, 0e0)", 2)} AS gpu_hours_week, {R("coalesce(cpu, 0e0)", 2)} AS cpu_hours_week,
               {R("100e0 * gc / nullif(j.c, 0)", 2)} AS gpu_cost_pct, coalesce(j.n, 0) AS total_jobs_week,
               coalesce(ok, 0) AS succeeded_week, coalesce(bad, 0) AS failed_week,
               {R("100e0 * ok / nullif(j.n, 0)", 2)} AS success_rate_week,
               peak.day AS peak_day, {R("peak.c", 4)} AS peak_day_cost,
               trough.day AS trough_day, {R("trough.c", 4)} AS trough_day_cost,
               coalesce(i.n, 0) AS incidents_total, coalesce(crit, 0) AS incidents_critical,
               coalesce(high, 0) AS incidents_high
        FROM {{tenants}} t LEFT JOIN j USING (tenant_id) LEFT JOIN peak USING (tenant_id)
        LEFT JOIN trough USING (tenant_id) LEFT JOIN i USING (tenant_id)""",
    # --- quality --------------------------------------------------------------------
    "dq_checks": f"""
        WITH c AS (
          SELECT {N("event_id IS NULL")} AS a, {N("cost_usd < 0")} AS b, {N(f"started_at > {NOW}")} AS c,
                 {N(W("'30' MINUTE", "ingested_at"))} AS d, {N("duration_seconds < 0")} AS e
          FROM {{job_events_dirty}})
        SELECT 'null_event_id' AS check_name, a AS value, a = 0 AS passed FROM c
        UNION ALL SELECT 'negative_cost', b, b = 0 FROM c
        UNION ALL SELECT 'future_start', c, c = 0 FROM c
        UNION ALL SELECT 'recent_rows', d, d > 0 FROM c
        UNION ALL SELECT 'negative_duration', e, e = 0 FROM c""",
    "dq_expectations": f"""
        WITH c AS (
          SELECT {N("event_id IS NULL")} AS v2, count(event_id) - count(DISTINCT event_id) AS v3,
                 {N("tenant_id IS NULL")} AS v4,
                 {N("status NOT IN ('SUCCEEDED', 'FAILED', 'RUNNING', 'QUEUED', 'CANCELLED')")} AS v5,
                 {N("cost_usd NOT BETWEEN 0 AND 10000")} AS v6,
                 {N("duration_seconds NOT BETWEEN 0 AND 172800")} AS v7,
                 {N("gpu_hours NOT BETWEEN 0 AND 1000")} AS v8, {N("started_at IS NULL")} AS v9,
                 {N("job_type NOT IN ('TRAINING', 'BATCH_PREDICTION', 'PIPELINE_RUN')")} AS v10
          FROM {{job_events_dirty}}),
        r(position, expectation, column_name, unexpected_count) AS (
          SELECT 1, 'expect_column_to_exist', 'event_id', 0 FROM c
          UNION ALL SELECT 2, 'expect_column_values_to_not_be_null', 'event_id', v2 FROM c
          UNION ALL SELECT 3, 'expect_column_values_to_be_unique', 'event_id', v3 FROM c
          UNION ALL SELECT 4, 'expect_column_values_to_not_be_null', 'tenant_id', v4 FROM c
          UNION ALL SELECT 5, 'expect_column_values_to_be_in_set', 'status', v5 FROM c
          UNION ALL SELECT 6, 'expect_column_values_to_be_between', 'cost_usd', v6 FROM c
          UNION ALL SELECT 7, 'expect_column_values_to_be_between', 'duration_seconds', v7 FROM c
          UNION ALL SELECT 8, 'expect_column_values_to_be_between', 'gpu_hours', v8 FROM c
          UNION ALL SELECT 9, 'expect_column_values_to_not_be_null', 'started_at', v9 FROM c
          UNION ALL SELECT 10, 'expect_column_values_to_be_in_set', 'job_type', v10 FROM c)
        SELECT CAST(position AS BIGINT) AS position, expectation, column_name,
               CAST(unexpected_count AS BIGINT) AS unexpected_count, unexpected_count = 0 AS success
        FROM r""",
    "dq_quarantine": f"""
        SELECT * FROM (
          SELECT event_id, tenant_id, cost_usd, duration_seconds, ingested_at, concat_ws(', ',
                 CASE WHEN event_id IS NULL THEN 'event_id null' END,
                 CASE WHEN tenant_id IS NULL THEN 'tenant_id null' END,
                 CASE WHEN status NOT IN ('SUCCEEDED', 'FAILED', 'RUNNING', 'QUEUED', 'CANCELLED')
                      THEN 'status not in set' END,
                 CASE WHEN cost_usd NOT BETWEEN 0 AND 10000 THEN 'cost_usd out of range' END,
                 CASE WHEN duration_seconds NOT BETWEEN 0 AND 172800
                      THEN 'duration_seconds out of range' END,
                 CASE WHEN gpu_hours NOT BETWEEN 0 AND 1000 THEN 'gpu_hours out of range' END,
                 CASE WHEN started_at IS NULL THEN 'started_at null' END,
                 CASE WHEN job_type NOT IN ('TRAINING', 'BATCH_PREDICTION', 'PIPELINE_RUN')
                      THEN 'job_type not in set' END,
                 CASE WHEN started_at > {NOW} THEN 'started_at in the future' END) AS reasons
          FROM {{job_events_dirty}}) WHERE reasons <> ''""",
    # --- slices and streams -----------------------------------------------------------
    "touched_slices": """
        SELECT DISTINCT CAST(started_at AS DATE) AS event_date, tenant_id FROM {raw_job_events}""",
    "stream_daily": f"""
        SELECT CAST(started_at AS DATE) AS metric_date, tenant_id, job_type, count(*) AS total_jobs,
               {N(OK)} AS succeeded_jobs, {N(BAD)} AS failed_jobs,
               {R(S("gpu_hours"), 4)} AS total_gpu_hours, {R(S("cpu_hours"), 4)} AS total_cpu_hours,
               {R(S("cost_usd"), 4)} AS total_cost_usd
        FROM {{job_events}} GROUP BY 1, 2, 3""",
}

_TEXTS["stream_daily_kept"] = _TEXTS["stream_daily"]

for _name, _view in (
    ("report_sql_daily_cost", "daily_cost_summary"),
    ("report_sql_latency", "latency_by_framework"),
    ("report_sql_gpu_spend", "weekly_gpu_spend"),
    ("report_sql_open_incidents", "open_incidents"),
):
    # The parameterised SQL reports give one tenant's part of the same dataset.
    _TEXTS[_name] = f"SELECT * FROM ({_TEXTS[_view]}) x WHERE tenant_id = 'client_demo'"

# NaN counts as missing: the same rules over a table where the amounts the fixtures spoil are NULL.
GAP = "duration_seconds % 17 = 0"
_CLEAN = (
    f"(SELECT * REPLACE (CASE WHEN {GAP} THEN NULL ELSE cost_usd END AS cost_usd, "
    f"CASE WHEN {GAP} THEN NULL ELSE gpu_hours END AS gpu_hours) FROM {{job_events}})"
)
for _name in ("cost_spikes", "cost_baseline", "daily_cost_summary"):
    _TEXTS[f"{_name}_dirty"] = _TEXTS[_name].replace("{job_events}", _CLEAN)
_TEXTS["inline_incidents_dirty"] = _TEXTS["inline_incidents"] + f"""
        WHERE incident_type <> 'COST_OVERRUN'
           OR job_id NOT IN (SELECT job_id FROM {{job_events}} WHERE {GAP})"""
_TEXTS["top_expensive_jobs_dirty"] = (
    _TEXTS["top_expensive_jobs"].replace("FROM {job_events}", f"FROM {_CLEAN} j").replace("{job_events}.cost_usd", "j.cost_usd")
)

# Ingestion: what has a tenant and a start time is stored once, as it came first.
_NO_TENANT, _NO_TIME = "duration_seconds % 29 = 0", "duration_seconds % 31 = 0"
_STORED = f"(SELECT * FROM {{job_events}} WHERE NOT ({_NO_TENANT} OR {_NO_TIME}))"
_TEXTS["ingest_events"] = f"""
    SELECT event_id, tenant_id, job_type, status, started_at, cost_usd, duration_seconds,
           CAST(started_at AS DATE) AS event_date FROM {_STORED} s"""
_TEXTS["ingest_incidents"] = f"""
    SELECT tenant_id, job_id, incident_type, severity, metric_value FROM {{incidents}}
    WHERE job_id IN (SELECT job_id FROM {_STORED} s)"""
_TEXTS["ingest_daily_metrics"] = (
    "SELECT * EXCLUDE (computed_at) FROM (" + _TEXTS["daily_metrics"].replace("{job_events}", _STORED) + ") m"
)
_TEXTS["ingest_quarantine"] = f"""
    SELECT DISTINCT event_id, concat_ws(', ', CASE WHEN {_NO_TIME} THEN 'started_at null' END,
                                        CASE WHEN {_NO_TENANT} THEN 'tenant_id null' END) AS reasons
    FROM {{job_events}} WHERE {_NO_TENANT} OR {_NO_TIME}"""

# Every batch holds the first third of the events again; repeats inside a batch are what did not succeed.
_TEXTS["ingest_expectations"] = f"""
    WITH e AS (SELECT *, CASE WHEN duration_seconds % 3 = 0 THEN 3 ELSE 1 END AS times FROM {{job_events}}),
    c AS (SELECT coalesce(sum(times) FILTER (WHERE status <> 'SUCCEEDED'), 0) AS v3, coalesce(sum(times) FILTER (WHERE {_NO_TENANT}), 0) AS v4,
                 coalesce(sum(times) FILTER (WHERE {_NO_TIME}), 0) AS v9 FROM e),
    r(position, expectation, column_name, n) AS (
      SELECT 1, 'expect_column_to_exist', 'event_id', 0
      UNION ALL SELECT 2, 'expect_column_values_to_not_be_null', 'event_id', 0
      UNION ALL SELECT 3, 'expect_column_values_to_be_unique', 'event_id', v3 FROM c
      UNION ALL SELECT 4, 'expect_column_values_to_not_be_null', 'tenant_id', v4 FROM c
      UNION ALL SELECT 5, 'expect_column_values_to_be_in_set', 'status', 0
      UNION ALL SELECT 6, 'expect_column_values_to_be_between', 'cost_usd', 0
      UNION ALL SELECT 7, 'expect_column_values_to_be_between', 'duration_seconds', 0
      UNION ALL SELECT 8, 'expect_column_values_to_be_between', 'gpu_hours', 0
      UNION ALL SELECT 9, 'expect_column_values_to_not_be_null', 'started_at', v9 FROM c
      UNION ALL SELECT 10, 'expect_column_values_to_be_in_set', 'job_type', 0)
    SELECT CAST(position AS BIGINT) AS position, expectation, column_name, CAST(n AS BIGINT) AS unexpected_count, n = 0 AS success FROM r"""
_TEXTS["stream_ingest"] = """
    SELECT event_id, tenant_id, job_type, status, started_at, cost_usd, duration_seconds FROM {job_events} WHERE status <> 'RUNNING'"""
_TEXTS["csv_export"] = _TEXTS["gpu_spend_weekly"]
_TEXTS["append_log"] = f"""
    SELECT tenant_id, digest_date, period, budget_status, CAST(2 AS BIGINT) AS copies, CAST(1 AS BIGINT) AS ids
    FROM ({_TEXTS["digest_rows"]}) d"""
_TEXTS["adhoc_query"] = """
    SELECT tenant_id, machine_type, count(*) AS jobs, max(duration_seconds) AS longest FROM {job_events}
    WHERE status = 'FAILED' GROUP BY ALL"""


def _fixed(x: str, digits: int) -> str:
    """Decimals as the JVM prints them: half up on the shortest decimal text."""
    return f"CAST(CAST(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)) AS DECIMAL(38, {digits})) AS VARCHAR)"


_TEXTS["incident_texts"] = f"""
    SELECT i.tenant_id, i.job_id, i.incident_type,
           CASE i.incident_type WHEN 'JOB_FAILURE' THEN concat('Job failed: ', job_name)
                WHEN 'LATENCY_SPIKE' THEN concat('Latency spike: ', job_name)
                ELSE concat('High-cost job: ', job_name, ' ($', {_fixed("cost_usd", 2)}, ')') END AS title,
           CASE i.incident_type
                WHEN 'JOB_FAILURE' THEN concat(i.job_id, ' (', job_type, ') ended as FAILED after ', duration_seconds, 's on ', machine_type, '.')
                WHEN 'LATENCY_SPIKE' THEN concat('Took ', duration_seconds, 's (', {_fixed("duration_seconds / 3600e0", 1)}, 'h), ',
                                                 {_fixed("duration_seconds / 3600e0", 1)}, 'x the baseline of 3600s.')
                ELSE concat('One job used $', {_fixed("cost_usd", 4)}, ', ', {_fixed("100e0 * cost_usd / (budget_weekly / 7e0)", 1)},
                            '% of the daily budget of $', format('{{:,.2f}}', budget_weekly / 7e0), '.') END AS description
    FROM {{incidents}} i JOIN {{job_events}} e ON e.job_id = i.job_id JOIN {{tenants}} t ON t.tenant_id = i.tenant_id"""


def _one(x: str, digits: int = 1) -> str:
    return f"coalesce({_fixed(x, digits)}, 'n/a')"


def _usd(x: str) -> str:
    return f"coalesce(concat('$', format('{{:,.2f}}', {x})), 'n/a')"


def _digest_lines(period: str, head: str, lines: list[str], listed: str, window: str) -> str:
    metrics = _TEXTS[f"digest_{period.lower()}_metrics"]
    fixed = ", ".join(["concat('Tenant: ', display_name)", head, *lines])
    close = "['', 'Answer with the JSON object described for digests, citing these numbers.']"
    rank = "CASE i.severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 4 END"
    rows = f"(SELECT m.*, t.display_name, t.budget_weekly, t.budget_weekly / 7e0 AS budget_daily FROM ({metrics}) m JOIN {{tenants}} t USING (tenant_id))"
    inc = f"(SELECT * FROM {{incidents}} WHERE {window})"
    return f"""
    SELECT tenant_id, '{period}' AS period, part, CAST(position AS INT) AS position, incident_id, line FROM (
      SELECT tenant_id, 0 AS part, generate_subscripts(l, 1) - 1 AS position, '' AS incident_id, unnest(l) AS line FROM (SELECT tenant_id, [{fixed}] AS l FROM {rows} m)
      UNION ALL SELECT tenant_id, 3, generate_subscripts(l, 1) - 1, '', unnest(l) FROM (SELECT tenant_id, {close} AS l FROM {{tenants}})
      UNION ALL SELECT DISTINCT tenant_id, 1, 0, '', '{listed}' FROM {inc} i
      UNION ALL SELECT tenant_id, 2, {rank}, incident_id, concat('  - ', severity, ': ', incident_type, ' — ', incident_type) FROM {inc} i) x"""


def _row(label: str, value: str) -> str:
    return f"concat('- {label}: ', {value})"


_TEXTS["digest_text"] = _digest_lines(
    "DAILY", "'Digest date: 2024-01-30'",
    [
        "''", "'## Spend & budget'", _row("Spend today", _usd("spend_today")), _row("Spend (7d)", _usd("spend_week")),
        _row("Weekly budget", _usd("budget_weekly")), _row("Daily budget (prorated)", _usd("budget_daily")),
        _row("Budget % used (rolling)", f"{_one('budget_pct_used')}, '%'"), _row("Monthly projection", _usd("monthly_projection")),
        "''", "'## Jobs (24h)'", _row("Total jobs", "total_jobs_today"), _row("SUCCEEDED", "succeeded_today"), _row("Failed", "failed_today"),
        _row("Success rate today", f"{_one('success_rate_today')}, '%'"), _row("Success rate (7d)", f"{_one('success_rate_7d')}, '%'"),
        _row("p95 duration (h)", _one("p95_hours_today", 2)), _row("Avg cost / job", _usd("avg_cost_today")),
        "''", "'## Utilization'", _row("GPU hours", _one("gpu_hours_today")), _row("CPU hours", _one("cpu_hours_today")),
        "''", "'## Incidents'", _row("Open incidents", "open_incidents"),
    ],
    "- Recent incidents (severity / type / title):", W("'24' HOUR", "detected_at"),
) + " UNION ALL " + _digest_lines(
    "WEEKLY", "'Week window: 2024-01-24 through 2024-01-30'",
    [
        "''", "'## Spend'", _row("Spend (week)", _usd("spend_week")), _row("Weekly budget", _usd("budget_weekly")),
        _row("Budget % used", f"{_one('budget_pct_used')}, '%'"), _row("Budget remaining", _usd("budget_remaining")),
        "''", "'## Utilization'", _row("GPU hours (week)", _one("gpu_hours_week")), _row("CPU hours (week)", _one("cpu_hours_week")),
        _row("GPU share of cost", f"{_one('gpu_cost_pct')}, '%'"),
        "''", "'## Jobs'", _row("Total jobs", "total_jobs_week"), _row("SUCCEEDED (week)", "succeeded_week"), _row("Failed (week)", "failed_week"),
        _row("Success rate", f"{_one('success_rate_week')}, '%'"),
        "''", "'## Peaks'", _row("Peak day", f"coalesce(CAST(peak_day AS VARCHAR), 'n/a'), ' (', {_usd('peak_day_cost')}, ')'"),
        _row("Trough day", f"coalesce(CAST(trough_day AS VARCHAR), 'n/a'), ' (', {_usd('trough_day_cost')}, ')'"),
        "''", "'## Incidents (week)'",
        "concat('- Total: ', incidents_total, ', CRITICAL: ', incidents_critical, ', HIGH: ', incidents_high)",
    ],
    "- Detail:", WEEK.replace("started_at", "detected_at"),
)
_TEXTS["overrun_notices"] = f"""
    SELECT b.tenant_id, display_name, concat(b.tenant_id, '@ops.example') AS alert_email, week_spend, b.budget_weekly, pct_used
    FROM ({_TEXTS["budget_status"].replace("{tenants}", "(SELECT * REPLACE (budget_weekly / 50e0 AS budget_weekly) FROM {tenants})")}) b
    JOIN {{tenants}} t ON t.tenant_id = b.tenant_id
    WHERE budget_status = 'Over budget' AND b.tenant_id <> 'client_internal'"""


def oracle_sql() -> dict[str, str]:
    return {name: oracle(text) for name, text in _TEXTS.items()}
