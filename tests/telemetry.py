"""Job events for the tests, as tuples and as tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import types as T

from fleetgauge.schemas import JOB_EVENTS

AS_OF = datetime(2024, 1, 31)
TENANTS = (
    ("client_acme", "ACME Corp", "acme-prod", "us-central1", 5000.0, 2.0,
     "acme@ops.example", "finance_primary", "a2-highgpu-1g", "open", True),
    ("client_demo", "Demo Client", "demo-dev", "us-east1", 2500.0, 3.0,
     "demo@ops.example", "technical_primary", "n1-standard-8", "restricted", True),
    ("client_internal", "Internal", "internal-ops", "us-west1", 15000.0, 4.0,
     "internal@ops.example", "technical_primary", "a2-highgpu-4g", "open", False),
)

BASE = {
    "job_name": "fraud-detection", "job_type": "TRAINING", "tenant_id": "client_demo",
    "project_id": "demo-dev", "region": "us-east1", "status": "SUCCEEDED", "model_id": "model-1",
    "framework": "pytorch", "machine_type": "n1-standard-4", "gpu_type": None, "gpu_count": 0,
    "replica_count": 1, "batch_size": 32, "dataset_size_gb": 1.0, "duration_seconds": 1000,
    "gpu_hours": 0.0, "cpu_hours": 0.2778, "cost_usd": 1.0,
}


def event(number, minutes_ago=10.0, as_of=AS_OF, **changes):
    """One job event as a tuple; times follow from ``minutes_ago`` unless given."""
    name = f"e{number}" if isinstance(number, int) else number
    row = {**BASE, "event_id": name, "job_id": f"job-{name}", **changes}
    start = row.setdefault("started_at", as_of - timedelta(minutes=minutes_ago))
    seconds = row["duration_seconds"] or 0
    row.setdefault("completed_at", start + timedelta(seconds=seconds) if start else None)
    row.setdefault("ingested_at", start + timedelta(seconds=5) if start else as_of)
    return tuple(row[f] for f in JOB_EVENTS.names)


def events(spark, rows):
    return spark.createDataFrame(rows, schema=_nullable())


def _nullable():
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in JOB_EVENTS])


def by(rows, *keys):
    """Collected rows as a dict keyed by the given columns."""
    pick = (lambda r: r[keys[0]]) if len(keys) == 1 else (lambda r: tuple(r[k] for k in keys))
    return {pick(r): r for r in rows}
