"""Job telemetry analytics as Spark jobs: ingest, metrics, health, anomalies, reports, digests."""

__version__ = "0.1.0"
