"""Binding of the driver's `events` table to job telemetry.

The driver's tables hold no job telemetry, so `job_events` and its companions
are defined as views over `events`. Each view is one SQL text that Spark and
DuckDB both accept; `{name}` stands for another view. Spark gets the text with
DataFrames bound to the names, the oracle gets it as CTEs.
"""

from __future__ import annotations

import re
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Declared, so that no job has to open the files just to learn their columns.
EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
AS_OF = datetime(2024, 1, 31)
SINCE = datetime(2024, 1, 1)
TODAY = date(2024, 1, 30)

# The view definitions.
VIEWS = {
    "tenants": """
        SELECT CAST(slot AS BIGINT) AS slot, tenant_id, display_name, project_id, region,
               CAST(budget_weekly AS DOUBLE) AS budget_weekly,
               CAST(sla_p95_hours AS DOUBLE) AS sla_p95_hours
        FROM (VALUES
          (0, 'client_acme',     'ACME Corp',   'acme-prod',    'us-central1',  5000.0, 2.0),
          (1, 'client_demo',     'Demo Client', 'demo-dev',     'us-east1',     2500.0, 3.0),
          (2, 'client_internal', 'Internal',    'internal-ops', 'us-west1',    15000.0, 4.0)
        ) t(slot, tenant_id, display_name, project_id, region, budget_weekly, sla_p95_hours)""",
    "rate_card": """
        SELECT CAST(slot AS BIGINT) AS slot, machine_type, gpu_type, gpu_count,
               CAST(gpu_rate AS DOUBLE) AS gpu_rate, CAST(cpu_rate AS DOUBLE) AS cpu_rate
        FROM (VALUES
          (0, 'n1-standard-4', NULL,                0, 0.0,  0.19),
          (1, 'n1-standard-8', NULL,                0, 0.0,  0.38),
          (2, 'n1-highmem-16', 'NVIDIA_TESLA_T4',   1, 0.35, 0.64),
          (3, 'a2-highgpu-1g', 'NVIDIA_TESLA_A100', 1, 2.93, 0.0),
          (4, 'a2-highgpu-4g', 'NVIDIA_TESLA_A100', 4, 2.93, 0.0)
        ) t(slot, machine_type, gpu_type, gpu_count, gpu_rate, cpu_rate)""",
    "job_base": """
        SELECT n, u, event_type, ts, duration_seconds, duration_seconds / 3600e0 AS hrs
        FROM (
          SELECT e.event_id AS n, e.user_id AS u, e.event_type, e.ts,
                 -- on the last day some jobs on machines with accelerators end almost at once
                 CAST(floor(e.value * CASE WHEN e.ts >= TIMESTAMP '2024-01-30 00:00:00'
                   AND e.event_id % 5 >= 2 AND e.event_id % 7 < 2 THEN 2 ELSE 72 END) AS INT)
                   AS duration_seconds
          FROM {events} e) d""",
    "job_events": """
        SELECT concat('evt-', CAST(b.n AS STRING)) AS event_id,
               concat('job-', CAST(b.n AS STRING)) AS job_id,
               CASE CAST(b.n % 4 AS INT) WHEN 0 THEN 'image-classification'
                    WHEN 1 THEN 'fraud-detection' WHEN 2 THEN 'demand-forecast'
                    ELSE 'ctr-model' END AS job_name,
               CASE CAST(b.n % 3 AS INT) WHEN 0 THEN 'TRAINING' WHEN 1 THEN 'BATCH_PREDICTION'
                    ELSE 'PIPELINE_RUN' END AS job_type,
               t.tenant_id, t.project_id, t.region,
               CASE WHEN b.event_type = 'error' THEN 'FAILED'
                    WHEN b.event_type = 'signup' AND b.n % 10 = 0 THEN 'RUNNING'
                    ELSE 'SUCCEEDED' END AS status,
               concat('model-', CAST(b.u AS STRING)) AS model_id,
               CASE CAST(b.u % 5 AS INT) WHEN 0 THEN 'tensorflow' WHEN 1 THEN 'pytorch'
                    WHEN 2 THEN 'sklearn' WHEN 3 THEN 'xgboost' ELSE 'jax' END AS framework,
               r.machine_type, r.gpu_type, r.gpu_count,
               CASE CAST(b.n % 3 AS INT) WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS replica_count,
               CASE CAST(b.u % 4 AS INT) WHEN 0 THEN 32 WHEN 1 THEN 64 WHEN 2 THEN 128
                    ELSE 256 END AS batch_size,
               CAST(b.n % 400 AS DOUBLE) / 2e0 + 0.5e0 AS dataset_size_gb,
               b.ts AS started_at,
               b.ts + b.duration_seconds * INTERVAL '1' SECOND AS completed_at,
               b.duration_seconds,
               floor(r.gpu_count * b.hrs * 1e4 + 0.5e0) / 1e4 AS gpu_hours,
               floor(b.hrs * 1e4 + 0.5e0) / 1e4 AS cpu_hours,
               floor(((floor(r.gpu_count * b.hrs * 1e4 + 0.5e0) / 1e4) * r.gpu_rate
                    + (floor(b.hrs * 1e4 + 0.5e0) / 1e4) * r.cpu_rate) * 1e6 + 0.5e0) / 1e6
                 AS cost_usd,
               b.ts + INTERVAL '5' SECOND AS ingested_at
        FROM {job_base} b
        JOIN {tenants} t ON t.slot = b.u % 3
        JOIN {rate_card} r ON r.slot = b.n % 5""",
    # Delivered at least once: everything that did not succeed arrives twice.
    "raw_job_events": """
        SELECT * FROM {job_events}
        UNION ALL SELECT * FROM {job_events} WHERE status <> 'SUCCEEDED'""",
    "job_events_dirty": """
        SELECT CASE WHEN duration_seconds % 101 = 1 THEN NULL ELSE event_id END AS event_id,
               tenant_id,
               CASE WHEN duration_seconds % 101 = 2 THEN 'LOST' ELSE status END AS status,
               CASE WHEN duration_seconds % 101 = 3 THEN 'ADHOC' ELSE job_type END AS job_type,
               CASE WHEN duration_seconds % 101 = 4 THEN -1e0 ELSE cost_usd END AS cost_usd,
               CASE WHEN duration_seconds % 101 = 5 THEN -1 ELSE duration_seconds END
                 AS duration_seconds,
               gpu_hours,
               CASE WHEN duration_seconds % 101 = 6 THEN NULL
                    WHEN duration_seconds % 101 = 7 THEN started_at + INTERVAL '60' DAY
                    ELSE started_at END AS started_at,
               ingested_at
        FROM {raw_job_events}""",
    "incidents": """
        SELECT concat('JOB_FAILURE|', e.event_id) AS incident_id, e.tenant_id, e.job_id,
               'JOB_FAILURE' AS incident_type, 'HIGH' AS severity,
               CAST(e.duration_seconds AS DOUBLE) AS metric_value,
               CAST(NULL AS DOUBLE) AS threshold_value,
               CASE WHEN e.duration_seconds % 3 = 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status,
               e.completed_at AS detected_at
        FROM {job_events} e WHERE e.status = 'FAILED'
        UNION ALL
        SELECT concat('LATENCY_SPIKE|', e.event_id), e.tenant_id, e.job_id, 'LATENCY_SPIKE',
               'MEDIUM', CAST(e.duration_seconds AS DOUBLE), 9000e0,
               CASE WHEN e.duration_seconds % 3 = 0 THEN 'RESOLVED' ELSE 'OPEN' END, e.completed_at
        FROM {job_events} e WHERE e.duration_seconds > 9000
        UNION ALL
        SELECT concat('COST_OVERRUN|', e.event_id), e.tenant_id, e.job_id, 'COST_OVERRUN',
               CASE WHEN e.cost_usd > t.budget_weekly / 7e0 * 0.25e0 THEN 'HIGH' ELSE 'MEDIUM' END,
               e.cost_usd, t.budget_weekly / 7e0 * 0.1e0,
               CASE WHEN e.duration_seconds % 3 = 0 THEN 'RESOLVED' ELSE 'OPEN' END, e.completed_at
        FROM {job_events} e JOIN {tenants} t ON e.tenant_id = t.tenant_id
        WHERE e.cost_usd > t.budget_weekly / 7e0 * 0.1e0""",
    # Some stored failures were raised to critical since, so there is something to escalate.
    "raised_incidents": """
        SELECT incident_id, tenant_id, incident_type, status, detected_at,
               CASE WHEN incident_type = 'JOB_FAILURE' AND CAST(metric_value AS BIGINT) % 2 = 0 THEN 'CRITICAL'
                    ELSE severity END AS severity
        FROM {incidents}""",
}


def _needs(name: str) -> list[str]:
    """Views a view reads, directly or not, in definition order."""
    wanted: set[str] = set()
    queue = [name]
    while queue:
        for other in re.findall(r"\{(\w+)\}", VIEWS[queue.pop()]):
            if other in VIEWS and other not in wanted:
                wanted.add(other)
                queue.append(other)
    return [v for v in VIEWS if v in wanted]


class Bound:
    """The views as DataFrames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, events: DataFrame | None = None):
        self.spark = spark
        if events is None:
            events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
        self._frames: dict[str, DataFrame] = {"events": events}

    @classmethod
    @lru_cache(maxsize=8)
    def over(cls, spark: SparkSession, sf_dir: str) -> "Bound":
        """The views of a folder, planned once per session (plans only, no data is kept)."""
        return cls(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._frames:
            text = VIEWS[name]
            used = set(re.findall(r"\{(\w+)\}", text))
            self._frames[name] = self.spark.sql(text, **{u: getattr(self, u) for u in used})
        return self._frames[name]


def oracle(text: str) -> str:
    """Prefix an oracle query with the views it names as ``{view}``."""
    direct = [v for v in dict.fromkeys(re.findall(r"\{(\w+)\}", text)) if v in VIEWS]
    wanted = {v for d in direct for v in (*_needs(d), d)}
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    ctes = [f"{v} AS ({plain(VIEWS[v])})" for v in VIEWS if v in wanted]
    body = plain(text).strip()
    if body.upper().startswith("WITH "):
        body = body[5:]
        return "WITH " + ", ".join([*ctes, body])
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
