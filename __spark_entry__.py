
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import timedelta
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures import AS_OF, EVENTS, SINCE, Bound  # noqa: E402
from fleetgauge.functions.clock import clip  # noqa: E402
from fleetgauge.functions.numeric import rnd  # noqa: E402
from fleetgauge.operators import detect, health, quality  # noqa: E402
from fleetgauge.operators.costs import with_costs  # noqa: E402
from fleetgauge.operators.incidents import (  # noqa: E402
    anomalies_to_incidents,
    checks_to_incidents,
    escalations,
    inline_incidents,
    open_incidents,
)
from fleetgauge.plans import digest, finance, metrics, operations, reports  # noqa: E402
from fleetgauge.session import work_dir  # noqa: E402
from fleetgauge.schemas import DAILY_METRICS  # noqa: E402
from fleetgauge.sources.events import apply_defaults, decode_events, read_lines_stream, read_table, scan_events  # noqa: E402
from fleetgauge.sources.events import query as adhoc  # noqa: E402
from fleetgauge.sources.sinks import append, export_csv, new_rows, to_payload, touched_slices  # noqa: E402
from fleetgauge.streaming import daily as stream_daily  # noqa: E402
from fleetgauge.streaming import ingest  # noqa: E402
from fleetgauge.streaming import kept as stream_kept  # noqa: E402
from oracles import oracle_sql as _oracle_sql  # noqa: E402

try:  # the training-data operators may be absent; everything else works without them
    from corpus_pipeline import ORACLE_SQL as _PIPELINE_SQL
    from corpus_pipeline import run as _pipeline
    from fleetgauge.llm import queries as _llm
except ImportError:
    _llm = None

#: Events whose lines one task makes or reads.
PART = 100_000
ROW = ("event_id", "tenant_id", "job_type", "status", "started_at", "cost_usd")
CHECK = ("tenant_id", "check_name", "passed", "severity", "metric", "threshold")
FOUND = ("tenant_id", "job_id", "anomaly_type", "severity", "metric_value", "threshold_value")


def _wire_lines(b: Bound) -> DataFrame:
    """Delivered events as JSON lines; a RUNNING job's line is not JSON at all."""
    ev = b.raw_job_events.drop("ingested_at")
    times = {c: F.col(c).cast("string") for c in ("started_at", "completed_at")}
    line = F.to_json(F.struct(*ev.columns))
    garbled = F.concat(F.lit("not json: "), F.col("job_id"))
    return ev.withColumns(times).select(
        F.when(F.col("status") == "RUNNING", garbled).otherwise(line).alias("value")
    )


def _json_decode(b: Bound) -> DataFrame:
    good, _ = decode_events(_wire_lines(b))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "completed_at")}
    return good.withColumns(times).select(
        "event_id", "tenant_id", "job_type", "status", "gpu_count", "started_at", "completed_at",
        "duration_seconds", "cost_usd",
    )


def _rejected(b: Bound) -> DataFrame:
    _, rejected = decode_events(_wire_lines(b))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def _defaults(b: Bound) -> DataFrame:
    gaps = {
        "gpu_count": F.nullif("gpu_count", F.lit(0)),
        "replica_count": F.nullif("replica_count", F.lit(1)),
        "gpu_hours": F.nullif("gpu_hours", F.lit(0.0)),
        "cpu_hours": F.when(F.col("status") != "RUNNING", F.col("cpu_hours")),
        "cost_usd": F.when(F.col("status") != "FAILED", F.col("cost_usd")),
        "ingested_at": F.when(F.col("job_type") != "TRAINING", F.col("ingested_at")),
    }
    return apply_defaults(b.job_events.withColumns(gaps), AS_OF).select("event_id", *gaps)


def _dedup(b: Bound) -> DataFrame:
    """Everything delivered, against a table that already holds the first half of the month."""
    stored = clip(b.job_events, before="2024-01-16")
    fresh = new_rows(b.raw_job_events, stored, "event_id")
    return fresh.select("event_id", "tenant_id", "job_id", "status", "started_at", "cost_usd")


def _tenant_dim(b: Bound) -> DataFrame:
    jobs = b.job_events.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("jobs"))
    return b.tenants.join(jobs, "tenant_id", "left").select(
        "tenant_id", "display_name", "project_id", "region", "budget_weekly", "sla_p95_hours",
        F.coalesce("jobs", F.lit(0)).alias("jobs"),
    )


def _spoiled(b: Bound) -> DataFrame:
    """Job events in which some amounts are NaN, as a JSON line may carry them."""
    gap, nan = F.col("duration_seconds") % 17 == 0, F.lit(float("nan"))
    return b.job_events.withColumns({c: F.when(gap, nan).otherwise(F.col(c)) for c in ("cost_usd", "gpu_hours")})


SPIKE = ("tenant_id", "event_id", "job_id", "severity", "metric_value", "threshold_value", "z_score")
INCIDENT = ("tenant_id", "job_id", "incident_type", "severity", "metric_value", "threshold_value", "detected_at")


def _baseline(ev: DataFrame) -> DataFrame:
    return detect.cost_baseline(ev, AS_OF).select(
        "tenant_id", "job_type", "machine_type",
        rnd("mean_cost", 6).alias("mean_cost"), rnd("std_cost", 6).alias("std_cost"),
    )


def _checks(b: Bound, *names: str) -> DataFrame:
    return health.health_checks(b.job_events, b.tenants, AS_OF, checks=names or health.CHECKS)


def _escalations(b: Bound) -> DataFrame:
    """Escalate over the incidents of one health and anomaly run plus the stored ones."""
    kind = ("incident_id", "tenant_id", "incident_type", "severity", "status", "detected_at")
    found = checks_to_incidents(_checks(b), AS_OF).select(*kind)
    odd = anomalies_to_incidents(detect.all_anomalies(b.job_events, AS_OF), AS_OF).select(*kind)
    rows = found.unionByName(odd).unionByName(b.raised_incidents.select(*kind))
    return escalations(rows, AS_OF).drop("incident_id")


def _quarantine(b: Bound) -> DataFrame:
    _, bad = quality.quarantine(b.job_events_dirty, AS_OF)
    return bad.select(
        "event_id", "tenant_id", "cost_usd", "duration_seconds", "ingested_at",
        F.array_join("reasons", ", ").alias("reasons"),
    )


def _touched(b: Bound) -> DataFrame:
    return touched_slices(b.raw_job_events.withColumn("event_date", F.to_date("started_at")))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the events table as a stream, drop repeats, keep daily totals, read them back."""
    # A glob, because a streaming source refuses the plain path of a single file.
    source = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")
    b = Bound(spark, sf_dir, events=source)
    delivered = b.raw_job_events.withColumn("started_at", F.col("started_at").cast("timestamp"))
    totals = stream_daily.stream_daily_totals(stream_daily.dedup_stream(delivered, delay="2 days"))
    out = work_dir(spark, "stream-daily")
    stream_daily.start_daily_totals(totals, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return stream_daily.latest_totals(spark.read.parquet(f"{out}/table"))


def _stream_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals with stored state: copies and old rows lie in all three parts, and each run is a restart."""
    out = work_dir(spark, "stream-kept")
    delivered = Bound(spark, sf_dir).raw_job_events
    delivered = delivered.withColumn("_part", F.pmod(F.xxhash64("event_id", "ingested_at"), F.lit(3)))
    for part in range(3):
        delivered.filter(F.col("_part") == part).drop("_part").write.parquet(f"{out}/feed/{part}")
        source = spark.readStream.schema(delivered.drop("_part").schema).parquet(f"{out}/feed/*")
        stream_kept.start_kept_totals(source, out, f"{out}/checkpoint").awaitTermination()
    return stream_kept.kept_totals(spark, out)


@lru_cache(maxsize=2)
def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Folder of tables after four micro-batches of JSON lines.

    Some events have no tenant, some a start that is no time. The second batch repeats the first one's
    ids with other days, the third repeats the first, and the third comes again as after a crash.
    """
    stored = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    # An event is a few bytes in its file and a kilobyte as a line, so tasks are cut by events, not by the file.
    b = Bound(spark, sf_dir, events=stored.repartition(1 + stored.count() // PART, "event_id"))
    seconds = F.col("duration_seconds")
    ev = b.raw_job_events.drop("ingested_at").withColumn("tenant_id", F.when(seconds % 29 != 0, F.col("tenant_id")))

    def lines(rows: DataFrame, days_back: int = 0) -> DataFrame:
        start = (F.col("started_at") - F.make_interval(days=F.lit(days_back))).cast("string")
        start = F.when(seconds % 31 == 0, F.lit("soon")).otherwise(start)
        times = {"started_at": start, "completed_at": F.col("completed_at").cast("string")}
        return rows.withColumns(times).select(F.to_json(F.struct(*rows.columns)).alias("value"))

    first, second, third = (ev.filter(seconds % 3 == i) for i in range(3))
    batches = [lines(first), lines(second).unionByName(lines(first, 2)), lines(third).unionByName(lines(first))]
    root = work_dir(spark, "ingest")
    write = ingest.make_batch_writer(root, b.tenants, lambda i: AS_OF + timedelta(minutes=i))
    for i in (0, 1, 2, 2):
        write(batches[i], i)
    return root


def _table_of(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: read_table(spark, _ingested(spark, sf_dir), name).select(*columns)


def _aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{_ingested(spark, sf_dir)}/quarantine")
    return rows.select("event_id", F.array_join(F.sort_array("reasons"), ", ").alias("reasons")).distinct()


def _expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{_ingested(spark, sf_dir)}/expectations")
    counted = rows.groupBy("position", "expectation", "column_name").agg(F.sum("unexpected_count").alias("unexpected_count"))
    return counted.withColumn("success", F.col("unexpected_count") == 0)


def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire lines as text files, half of them a micro-batch, through the whole ingestion stream."""
    b, folder = Bound.over(spark, sf_dir), work_dir(spark, "stream-ingest")
    half = 1 + b.events.count() // (2 * PART)
    _wire_lines(b).repartition(2 * half).write.text(f"{folder}/topic")
    lines = read_lines_stream(spark, f"{folder}/topic", files_per_trigger=half)
    write = ingest.make_batch_writer(f"{folder}/tables", b.tenants, lambda i: AS_OF + timedelta(minutes=i))
    ingest.start_ingest(lines, write, f"{folder}/checkpoint", every=None).awaitTermination()
    return read_table(spark, f"{folder}/tables", "job_events").select(*ROW, "duration_seconds")


def _csv(b: Bound) -> DataFrame:
    rows = reports.gpu_spend_weekly(b.job_events)
    folder = work_dir(b.spark, "csv")
    export_csv(rows, folder)
    return b.spark.read.schema(rows.schema).option("header", True).csv(folder)


def _append(b: Bound) -> DataFrame:
    """Two appends to the digest log: a log keeps what comes, twice what comes twice."""
    rows = digest.digest_rows(b.job_events, b.incidents, b.tenants, AS_OF)
    root = work_dir(b.spark, "log")
    for _ in range(2):
        append(rows, root, "digests")
    stored = read_table(b.spark, root, "digests").groupBy("tenant_id", "digest_date", "period", "budget_status")
    return stored.agg(F.count(F.lit(1)).alias("copies"), F.countDistinct("digest_id").alias("ids"))


def _adhoc(b: Bound) -> DataFrame:
    text = "SELECT tenant_id, machine_type, count(*) AS jobs, max(duration_seconds) AS longest FROM ev WHERE status = :s GROUP BY ALL"
    return adhoc(b.spark, text, {"ev": b.job_events}, s="FAILED")


def _digest_text(b: Bound) -> DataFrame:
    """Every line of both digests of every tenant."""
    daily = digest.digest_daily_metrics(b.job_events, b.incidents, b.tenants, AS_OF)
    weekly = digest.digest_weekly_metrics(b.job_events, b.incidents, b.tenants, AS_OF)
    rows = [
        digest.digest_lines(m, b.incidents, b.tenants, AS_OF, period).withColumn("period", F.lit(period))
        for m, period in ((daily, "DAILY"), (weekly, "WEEKLY"))
    ]
    return rows[0].unionByName(rows[1]).select("tenant_id", "period", "part", "position", "incident_id", "line")


def _notices(b: Bound) -> DataFrame:
    """Notices of a month's spend against a weekly budget, so that somebody is over it."""
    ten = b.tenants.withColumns(
        {"alert_email": F.concat("tenant_id", F.lit("@ops.example")), "notify_on_overrun": F.col("tenant_id") != "client_internal"}
    )
    small = ten.withColumn("budget_weekly", F.col("budget_weekly") / F.lit(50.0))
    return finance.overrun_notices(finance.budget_status(b.job_events, small, AS_OF), small)


_INGEST = {
    "ingest_events": _table_of("job_events", *ROW, "duration_seconds", "event_date"),
    "ingest_incidents": _table_of("incidents", "tenant_id", "job_id", "incident_type", "severity", "metric_value"),
    "ingest_daily_metrics": _table_of(
        "daily_metrics", *(c for c in DAILY_METRICS.names if c != "computed_at"), "tenant_day_over_budget"
    ),
    "ingest_quarantine": _aside,
    "ingest_expectations": _expectations,
    "stream_ingest": _stream_ingest,
}


def _report(name: str, **args: str) -> Callable[[Bound], DataFrame]:
    def run(b: Bound) -> DataFrame:
        b.job_events.createOrReplaceTempView("job_events")
        columns = [f"CAST(NULL AS STRING) AS {c}" for c in ("title", "description", "recommended_action")]
        b.incidents.selectExpr("*", *columns).createOrReplaceTempView("incidents")
        df = reports.report_sql(b.spark, name, tenant_id="client_demo", **args)
        return df.drop("title", "description", "recommended_action")

    return run


_since = {"since_date": "2024-01-01"}
_BOUND: dict[str, Callable[[Bound], DataFrame]] = {
    # scans, decoding, loading
    "job_events_scan": lambda b: scan_events(b.job_events),
    "json_decode": _json_decode,
    "rejected_lines": _rejected,
    "defaults_applied": _defaults,
    "dedup_events": _dedup,
    "publish_payload": lambda b: to_payload(
        b.job_events.select("event_id", "tenant_id", "status", "gpu_type", "duration_seconds")
    ),
    "tenant_dim": _tenant_dim,
    "cost_enrichment": lambda b: with_costs(
        b.job_events.drop("gpu_type", "gpu_count", "gpu_hours", "cpu_hours", "cost_usd"), b.rate_card
    ).select("event_id", "gpu_type", "gpu_count", "gpu_hours", "cpu_hours", "cost_usd"),
    "csv_export": _csv,
    "append_log": _append,
    "adhoc_query": _adhoc,
    # filters and scalar expressions
    "filter_tenant": lambda b: scan_events(b.job_events, tenant="client_demo").select(*ROW),
    "filter_since": lambda b: scan_events(b.job_events, since="2024-01-15").select(*ROW),
    "trailing_windows": lambda b: operations.window_counts(b.job_events, AS_OF),
    "date_functions": lambda b: operations.time_parts(b.job_events, AS_OF),
    "severity_tiers": lambda b: operations.severity_by_day(b.job_events, b.tenants, SINCE),
    # reports
    "daily_cost_summary": lambda b: reports.daily_cost_summary(b.job_events, SINCE),
    "latency_by_framework": lambda b: reports.latency_by_framework(b.job_events, SINCE),
    "weekly_gpu_spend": lambda b: reports.weekly_gpu_spend(b.job_events, SINCE),
    "job_success_rate": lambda b: reports.job_success_rate(b.job_events),
    "gpu_spend_weekly": lambda b: reports.gpu_spend_weekly(b.job_events),
    "report_sql_daily_cost": _report("daily_cost_summary", **_since),
    "report_sql_latency": _report("latency_by_framework", **_since),
    "report_sql_gpu_spend": _report("weekly_gpu_spend", **_since),
    "report_sql_open_incidents": _report("open_incidents_ranked", as_of="2024-01-31 00:00:00"),
    "daily_metrics": lambda b: metrics.daily_metrics(b.job_events, b.tenants, AS_OF),
    "technical_kpis": lambda b: operations.technical_kpis(b.job_events, b.incidents, b.tenants, SINCE),
    "open_incidents": lambda b: open_incidents(b.incidents, AS_OF),
    "open_incidents_top20": lambda b: open_incidents(b.incidents, AS_OF, top=20),
    "volume_trend": lambda b: operations.volume_trend(b.job_events, SINCE),
    "latency_box": lambda b: operations.latency_box(b.job_events, SINCE),
    "failure_heatmap": lambda b: operations.failure_heatmap(b.job_events, SINCE),
    "failure_heatmap_pivot": lambda b: operations.failure_heatmap_pivot(b.job_events, SINCE),
    "budget_status": lambda b: finance.budget_status(b.job_events, b.tenants, AS_OF),
    "spend_projection": lambda b: finance.spend_projection(b.job_events, b.tenants, SINCE, AS_OF),
    "weekly_spend_vs_budget": lambda b: finance.weekly_spend_vs_budget(b.job_events, b.tenants, SINCE),
    "spend_by_job_type": lambda b: finance.spend_by_job_type(b.job_events, SINCE),
    "resource_cost_split": lambda b: operations.resource_cost_split(b.job_events, SINCE),
    "daily_spend": lambda b: finance.daily_spend(b.job_events, b.tenants, SINCE),
    "top_expensive_jobs": lambda b: finance.top_expensive_jobs(b.job_events, SINCE),
    "latency_spikes_rolling": lambda b: detect.latency_spikes_rolling(b.job_events),
    "ingest_window_status": lambda b: operations.ingest_window_status(b.job_events, AS_OF),
    "sla_breaches": lambda b: operations.sla_breaches(b.job_events, b.tenants, SINCE),
    # health
    "success_rate_1h": lambda b: _checks(b, "success_rate_1h").select(*CHECK),
    "success_rate_24h": lambda b: _checks(b, "success_rate_24h").select(*CHECK),
    "p95_latency": lambda b: _checks(b, "p95_latency").select(*CHECK),
    "daily_budget": lambda b: _checks(b, "daily_budget").select(*CHECK),
    "staleness": lambda b: _checks(b, "pipeline_staleness").select(*CHECK),
    "gpu_efficiency": lambda b: _checks(b, "gpu_cost_efficiency").select(*CHECK),
    "health_checks": lambda b: _checks(b).select(*CHECK),
    "health_report": lambda b: health.health_report(_checks(b), AS_OF),
    "health_run_summary": lambda b: health.health_run_summary(
        _checks(b), detect.all_anomalies(b.job_events, AS_OF)
    ),
    # detectors
    "cost_baseline": lambda b: _baseline(b.job_events),
    "cost_spikes": lambda b: detect.cost_spikes(b.job_events, AS_OF).select(*SPIKE),
    "duration_fence": lambda b: detect.duration_fence(b.job_events, AS_OF),
    "duration_outliers": lambda b: detect.duration_outliers(b.job_events, AS_OF).select(
        "tenant_id", "event_id", "job_id", "severity", "metric_value", "threshold_value"
    ),
    "failure_rates": lambda b: detect.failure_rates(b.job_events, AS_OF).select(
        "tenant_id", "recent_jobs", "recent_failed", "baseline_jobs", "baseline_failed",
        rnd("recent_rate", 2).alias("recent_rate"), rnd("baseline_rate", 2).alias("baseline_rate"),
    ),
    "failure_bursts": lambda b: detect.failure_bursts(b.job_events, AS_OF).select(
        "tenant_id", "severity", "metric_value", "threshold_value"
    ),
    "gpu_waste_rates": lambda b: detect.gpu_waste_rates(b.job_events, AS_OF).select(
        "tenant_id", "gpu_jobs", "short_jobs", rnd("waste_pct", 2).alias("waste_pct"),
        rnd("avg_wasted_cost", 6).alias("avg_wasted_cost"),
    ),
    "gpu_waste_pattern": lambda b: detect.gpu_waste_pattern(b.job_events, AS_OF).select(
        "tenant_id", "severity", "gpu_jobs", "short_jobs", "metric_value", "threshold_value",
        rnd("avg_wasted_cost", 6).alias("avg_wasted_cost"),
    ),
    "inline_incidents": lambda b: inline_incidents(b.job_events, b.tenants).select(*INCIDENT),
    "incident_texts": lambda b: inline_incidents(b.job_events, b.tenants).select(
        "tenant_id", "job_id", "incident_type", "title", "description"
    ),
    "overrun_notices": _notices,
    # the same over amounts that are NaN
    "cost_baseline_dirty": lambda b: _baseline(_spoiled(b)),
    "cost_spikes_dirty": lambda b: detect.cost_spikes(_spoiled(b), AS_OF).select(*SPIKE),
    "daily_cost_summary_dirty": lambda b: reports.daily_cost_summary(_spoiled(b), SINCE),
    "top_expensive_jobs_dirty": lambda b: finance.top_expensive_jobs(_spoiled(b), SINCE),
    "inline_incidents_dirty": lambda b: inline_incidents(_spoiled(b), b.tenants).select(*INCIDENT),
    "all_anomalies": lambda b: detect.all_anomalies(b.job_events, AS_OF).select(*FOUND),
    "escalations": _escalations,
    # digests
    "digest_snapshot": lambda b: digest.digest_snapshot(b.job_events, b.incidents, b.tenants, AS_OF),
    "digest_rows": lambda b: digest.digest_rows(b.job_events, b.incidents, b.tenants, AS_OF).drop(
        "digest_id", "summary_text"
    ),
    "digest_daily_metrics": lambda b: digest.digest_daily_metrics(
        b.job_events, b.incidents, b.tenants, AS_OF
    ),
    "digest_weekly_metrics": lambda b: digest.digest_weekly_metrics(
        b.job_events, b.incidents, b.tenants, AS_OF
    ),
    "digest_text": _digest_text,
    # quality
    "dq_checks": lambda b: quality.dq_checks(b.job_events_dirty, AS_OF),
    "dq_expectations": lambda b: quality.expect(b.job_events_dirty),
    "dq_quarantine": _quarantine,
    # slices
    "touched_slices": _touched,
}


def entry(spark: SparkSession) -> DataFrame:
    """Daily cost summary of all tenants at the smallest scale."""
    return queries()["daily_cost_summary"](spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The datasets over job telemetry; each takes (spark, folder of driver tables)."""

    def bind(build: Callable[[Bound], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Bound.over(spark, sf_dir))

    return {**{name: bind(build) for name, build in _BOUND.items()}, "stream_daily": _stream, "stream_daily_kept": _stream_kept, **_INGEST}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every dataset by name, and the training-data operators where they are present."""
    return own_queries() if _llm is None else {**own_queries(), **_llm.queries(), "pipeline": _pipeline}


def oracle_sql() -> dict[str, str]:
    if _llm is None:
        return _oracle_sql()
    pipeline = {} if _PIPELINE_SQL is None else {"pipeline": _PIPELINE_SQL}
    return {**_oracle_sql(), **_llm.oracle_sql(), **pipeline}
