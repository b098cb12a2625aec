"""Whole runs over the stored tables, to be called by any scheduler.

Each run may be repeated for the same ``as_of``: incidents and digests are
inserted by their stable ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.clock import Moment
from .operators.detect import all_anomalies
from .operators.health import health_checks, health_run_summary
from .operators.incidents import anomalies_to_incidents, as_stored_incidents, checks_to_incidents, escalations
from .operators.quality import assert_quality, dq_checks
from .plans.arrivals import day_ledger, ledger_checks, recent_arrivals, stamp_ledger
from .plans.digest import digest_rows
from .plans.metrics import refresh_daily_metrics
from .plans.operations import ingest_window_incident
from .schemas import STORED
from .sources.dimensions import literal_table
from .sources.events import read_table, table_exists
from .sources.sinks import append_new


def _incidents(spark: SparkSession, root: str, found: DataFrame) -> None:
    append_new(spark, as_stored_incidents(found), root, "incidents", "incident_id")


def _stored_incidents(spark: SparkSession, root: str) -> DataFrame:
    """The incident table; empty with the right columns before the first incident."""
    if table_exists(spark, f"{root}/incidents"):
        return read_table(spark, root, "incidents")
    return spark.createDataFrame([], STORED["incidents"])


def run_health(spark: SparkSession, root: str, ten: DataFrame, as_of: Moment, **limits) -> DataFrame:
    """Check health, look for anomalies, store both as incidents; returns the run summary."""
    ev = read_table(spark, root, "job_events")
    # A few rows per tenant each; kept so that storing and counting them does
    # not read the events again.
    arrivals = stamp_ledger(spark, root)
    checks = health_checks(ev, ten, as_of, arrivals=arrivals.read() if arrivals.exists() else None, **limits).persist()
    anomalies = all_anomalies(ev, as_of).persist()
    try:
        _incidents(spark, root, checks_to_incidents(checks, as_of))
        _incidents(spark, root, anomalies_to_incidents(anomalies, as_of))
        summary = health_run_summary(checks, anomalies)
        return literal_table(spark, summary.collect(), summary.schema)
    finally:
        checks.unpersist()
        anomalies.unpersist()


def critical_incidents(spark: SparkSession, root: str, as_of: Moment) -> DataFrame:
    """The stored incidents to page someone about."""
    return escalations(_stored_incidents(spark, root), as_of)


def run_quality_and_metrics(
    spark: SparkSession, root: str, ten: DataFrame, slices: DataFrame, as_of: Moment, window_minutes: float = 20
) -> None:
    """Quality gate, metrics of the given (event_date, tenant_id) slices, then the window report.

    The window report is written even when the gate stops the run.
    """
    ev = read_table(spark, root, "job_events")
    try:
        counted = day_ledger(spark, root).exists()
        assert_quality(ledger_checks(spark, root, ev, as_of) if counted else dq_checks(ev, as_of))
        refresh_daily_metrics(spark, root, ten, slices, as_of)
    finally:
        counts = recent_arrivals(spark, root, as_of, window_minutes) if stamp_ledger(spark, root).exists() else None
        _incidents(spark, root, ingest_window_incident(ev, as_of, window_minutes, counts))


def run_digests(
    spark: SparkSession, root: str, ten: DataFrame, as_of: Moment, period: str = "DAILY"
) -> DataFrame:
    """Store one digest per tenant for the day of ``as_of``; returns the stored rows."""
    ev = read_table(spark, root, "job_events")
    rows = digest_rows(ev, _stored_incidents(spark, root), ten, as_of, period)
    append_new(spark, rows, root, "digests", "digest_id")
    return read_table(spark, root, "digests").filter(F.col("period") == period)
