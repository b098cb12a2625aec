"""Declared schemas of the wire record and of every stored table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE, NTZ = T.BooleanType(), T.DateType(), T.TimestampNTZType()

# Name, type and whether it may be null, of each column in order.
JOB_EVENTS = T.StructType(
    [
        T.StructField("event_id", STRING, False),
        T.StructField("job_id", STRING, False),
        T.StructField("job_name", STRING, False),
        T.StructField("job_type", STRING, False),
        T.StructField("tenant_id", STRING, False),
        T.StructField("project_id", STRING, False),
        T.StructField("region", STRING, False),
        T.StructField("status", STRING, False),
        T.StructField("model_id", STRING, True),
        T.StructField("framework", STRING, True),
        T.StructField("machine_type", STRING, False),
        T.StructField("gpu_type", STRING, True),
        T.StructField("gpu_count", INT, True),
        T.StructField("replica_count", INT, True),
        T.StructField("batch_size", INT, True),
        T.StructField("dataset_size_gb", DOUBLE, True),
        T.StructField("started_at", NTZ, True),
        T.StructField("completed_at", NTZ, True),
        T.StructField("duration_seconds", INT, True),
        T.StructField("gpu_hours", DOUBLE, True),
        T.StructField("cpu_hours", DOUBLE, True),
        T.StructField("cost_usd", DOUBLE, True),
        T.StructField("ingested_at", NTZ, True),
    ]
)

DAILY_METRICS = T.StructType(
    [
        T.StructField("metric_date", DATE, False),
        T.StructField("tenant_id", STRING, False),
        T.StructField("job_type", STRING, False),
        T.StructField("total_jobs", BIGINT, True),
        T.StructField("succeeded_jobs", BIGINT, True),
        T.StructField("failed_jobs", BIGINT, True),
        T.StructField("total_gpu_hours", DOUBLE, True),
        T.StructField("total_cpu_hours", DOUBLE, True),
        T.StructField("total_cost_usd", DOUBLE, True),
        T.StructField("avg_duration_sec", DOUBLE, True),
        T.StructField("p95_duration_sec", DOUBLE, True),
        T.StructField("budget_threshold", DOUBLE, True),
        T.StructField("is_over_budget", BOOLEAN, True),
        T.StructField("computed_at", NTZ, True),
    ]
)

INCIDENTS = T.StructType(
    [
        T.StructField("incident_id", STRING, False),
        T.StructField("tenant_id", STRING, False),
        T.StructField("job_id", STRING, True),
        T.StructField("incident_type", STRING, False),
        T.StructField("severity", STRING, False),
        T.StructField("title", STRING, False),
        T.StructField("description", STRING, True),
        T.StructField("metric_value", DOUBLE, True),
        T.StructField("threshold_value", DOUBLE, True),
        T.StructField("recommended_action", STRING, True),
        T.StructField("status", STRING, True),
        T.StructField("detected_at", NTZ, True),
        T.StructField("resolved_at", NTZ, True),
    ]
)

DIGESTS = T.StructType(
    [
        T.StructField("digest_id", STRING, False),
        T.StructField("tenant_id", STRING, False),
        T.StructField("digest_date", DATE, False),
        T.StructField("period", STRING, False),
        T.StructField("summary_text", STRING, False),
        T.StructField("incidents_count", BIGINT, True),
        T.StructField("total_cost_usd", DOUBLE, True),
        T.StructField("budget_status", STRING, True),
        T.StructField("generated_at", NTZ, True),
    ]
)

TENANTS = T.StructType(
    [
        T.StructField("tenant_id", STRING, False),
        T.StructField("display_name", STRING, True),
        T.StructField("project_id", STRING, True),
        T.StructField("region", STRING, True),
        T.StructField("budget_weekly", DOUBLE, True),
        T.StructField("sla_p95_hours", DOUBLE, True),
        T.StructField("alert_email", STRING, True),
        T.StructField("dashboard_view", STRING, True),
        T.StructField("machine_type_preference", STRING, True),
        T.StructField("gpu_policy", STRING, True),
        T.StructField("notify_on_overrun", BOOLEAN, True),
    ]
)

RATE_CARD = T.StructType(
    [
        T.StructField("machine_type", STRING, False),
        T.StructField("gpu_type", STRING, True),
        T.StructField("gpu_count", INT, True),
        T.StructField("gpu_rate", DOUBLE, True),
        T.StructField("cpu_rate", DOUBLE, True),
    ]
)

# The wire record is the stored event with times as text, no arrival time,
# and two sender-side fields. Everything may be missing on the wire.
WIRE_EVENT = T.StructType(
    [
        T.StructField(
            f.name,
            T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType,
            True,
        )
        for f in JOB_EVENTS
        if f.name != "ingested_at"
    ]
    + [T.StructField("is_anomaly", T.BooleanType()), T.StructField("emitted_at", T.StringType())]
)

# What a missing column becomes on load.
EVENT_DEFAULTS = {
    "gpu_count": 0,
    "replica_count": 1,
    "gpu_hours": 0.0,
    "cpu_hours": 0.0,
    "cost_usd": 0.0,
}

# Stored layout. The date companions are DATE columns: unlike TIMESTAMP_NTZ,
# DATE predicates prune partitions and skip Parquet row groups.
DATE_COMPANION = {
    "started_at": "event_date",
    "ingested_at": "ingest_date",
    "detected_at": "detected_date",
}
PARTITIONS = {
    "job_events": ("event_date", "tenant_id"),
    "daily_metrics": ("metric_date", "tenant_id"),
    "incidents": ("detected_date", "tenant_id"),
    "digests": ("digest_date",),
}
STORED = {
    "job_events": T.StructType(
        JOB_EVENTS.fields
        + [T.StructField("ingest_date", T.DateType()), T.StructField("event_date", T.DateType())]
    ),
    "daily_metrics": T.StructType(
        DAILY_METRICS.fields + [T.StructField("tenant_day_over_budget", T.BooleanType())]
    ),
    "incidents": T.StructType(
        INCIDENTS.fields
        + [
            T.StructField("detected_date", T.DateType()),
            T.StructField("subject_date", T.DateType()),
        ]
    ),
    "digests": DIGESTS,
}
#: Tables whose slices are replaced, in a layout of parts (:mod:`.sources.slices`).
SLICED = ("daily_metrics",)
_DDL_DEFAULTS = {
    "job_events": EVENT_DEFAULTS,
    "incidents": {"status": "'OPEN'"},
    "daily_metrics": {
        "total_jobs": 0, "succeeded_jobs": 0, "failed_jobs": 0, "total_gpu_hours": 0.0,
        "total_cpu_hours": 0.0, "total_cost_usd": 0.0, "avg_duration_sec": 0.0,
        "p95_duration_sec": 0.0, "budget_threshold": 0.0, "is_over_budget": "false",
    },
    "digests": {"incidents_count": 0, "total_cost_usd": 0.0},
}


def table_ddl(name: str, location: str | None = None) -> str:
    """``CREATE TABLE`` text of one stored table, with defaults and required columns."""
    defaults = _DDL_DEFAULTS[name]
    columns = []
    for f in STORED[name]:
        text = f"{f.name} {f.dataType.simpleString()}"
        if not f.nullable:
            text += " NOT NULL"
        if f.name in defaults:
            value = defaults[f.name]
            text += f" DEFAULT {value}D" if isinstance(value, float) else f" DEFAULT {value}"
        columns.append(text)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet"
    ddl += f" PARTITIONED BY ({', '.join(PARTITIONS[name])})"
    return ddl + (f" LOCATION '{location}'" if location else "")


def create_tables(spark: SparkSession, root: str | None = None) -> None:
    """Create the four tables in the session's current database."""
    for name in STORED:
        spark.sql(table_ddl(name, f"{root}/{name}" if root else None))
