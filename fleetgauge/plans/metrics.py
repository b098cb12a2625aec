"""Daily metrics: the aggregate and its incremental refresh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import Moment, stamp
from ..functions.numeric import from_units, ratio, rnd
from ..functions.quantiles import histogram, of_histogram, summarize
from ..schemas import BIGINT, DAILY_METRICS, DATE, INT, STRING
from ..settings import HealthLimits
from ..sources.dimensions import with_budget
from ..sources.events import read_table
from ..sources.ledger import Ledger, Shape
from ..sources.sinks import replace_slices, touched_days
from .measures import amounts, counts, known, total


KEYS = ("metric_date", "tenant_id", "job_type")


def daily_metrics(
    ev: DataFrame,
    ten: DataFrame,
    as_of: Moment,
    slices: DataFrame | None = None,
    overrun_pct: float = HealthLimits().overrun_pct,
    approx: bool = False,
) -> DataFrame:
    """Totals per day, tenant and job type against the daily budget.

    ``slices`` (event_date, tenant_id) limits the work to those slices.
    ``is_over_budget`` compares one job type's spend, as the stored column
    always did; ``tenant_day_over_budget`` compares the tenant's whole day.
    """
    rows = _dated(ev)
    if slices is not None:
        rows = rows.join(slices.select(F.col("event_date").alias("metric_date"), "tenant_id"), list(KEYS[:2]), "left_semi")
    return _shaped(summarize(rows, KEYS, _measures(), value="duration_seconds", at=(0.95,), approx=approx), ten, as_of, overrun_pct)


def _dated(ev: DataFrame) -> DataFrame:
    if "event_date" not in ev.columns:
        ev = ev.withColumn("event_date", F.to_date("started_at"))
    return ev.filter(F.col("started_at").isNotNull()).withColumn("metric_date", F.col("event_date"))


def _measures() -> dict[str, Column]:
    return {
        **counts(),
        **amounts("gpu_hours", "cpu_hours", "cost_usd"),
        "seconds_sum": F.col("duration_seconds").cast("bigint"),
        **known("duration_seconds"),
    }


def _shaped(grouped: DataFrame, ten: DataFrame, as_of: Moment, overrun_pct: float) -> DataFrame:
    limit = F.col("budget_weekly") / F.lit(7.0) * F.lit(1 + overrun_pct / 100)
    day = W.partitionBy("metric_date", "tenant_id")
    shaped = with_budget(grouped, ten).select(
        "metric_date", "tenant_id", "job_type",
        F.col("jobs_n").alias("total_jobs"),
        F.col("ok_n").alias("succeeded_jobs"),
        F.col("failed_n").alias("failed_jobs"),
        total("gpu_hours", 4).alias("total_gpu_hours"),
        total("cpu_hours", 4).alias("total_cpu_hours"),
        total("cost_usd", 4).alias("total_cost_usd"),
        rnd(ratio("seconds_sum", "duration_seconds_n"), 1).alias("avg_duration_sec"),
        rnd(rnd(F.element_at("q", 1), 2), 1).alias("p95_duration_sec"),
        (F.col("budget_weekly") / F.lit(7.0)).alias("budget_threshold"),
        (from_units("cost_usd_u") > limit).alias("is_over_budget"),
        stamp(as_of).alias("computed_at"),
        # A few rows per tenant and day: the window runs over the aggregate.
        (from_units(F.sum("cost_usd_u").over(day)) > limit).alias("tenant_day_over_budget"),
    )
    return shaped.select(*DAILY_METRICS.names, "tenant_day_over_budget")


def metric_rows(ev: DataFrame) -> DataFrame:
    """What events add to the stored histograms of their days: counts and sums per second of duration."""
    return histogram(_dated(ev), KEYS, _measures(), "duration_seconds").withColumnRenamed("_value", "seconds")


_MEASURES = ("jobs_n", "ok_n", "failed_n", "gpu_hours_u", "cpu_hours_u", "cost_usd_u", "seconds_sum", "duration_seconds_n")
_HISTOGRAM = Shape(
    T.StructType(
        [T.StructField(c, k) for c, k in zip((*KEYS, "seconds"), (DATE, STRING, STRING, INT), strict=True)]
        + [T.StructField(c, BIGINT) for c in ("_weight", *_MEASURES)]
    ),
    (*KEYS, "seconds"), "metric_date",
)


def metric_ledger(spark: SparkSession, root: str) -> Ledger:
    """The stored histograms; ``metric_rows`` of every event table row, added by the batch that brought it."""
    return Ledger(spark, f"{root}/daily_histograms", _HISTOGRAM)


def refresh_from_ledger(
    spark: SparkSession, root: str, ten: DataFrame, slices: DataFrame, as_of: Moment, overrun_pct: float = HealthLimits().overrun_pct
) -> None:
    """Replace the given (event_date, tenant_id) slices from the stored histograms, all in one commit. No event is read.

    The percentile stays exact: histograms of whole seconds are added, not estimates.
    """

    def rows(staged: DataFrame) -> DataFrame:
        days = [r[0] for r in staged.select("metric_date").distinct().collect()]
        added = metric_ledger(spark, root).read(days=days).withColumnRenamed("seconds", "_value")
        grouped = of_histogram(added.join(staged, list(KEYS[:2]), "left_semi"), KEYS, _MEASURES, (0.95,))
        return _shaped(grouped, ten, as_of, overrun_pct)

    named = slices.dropna().withColumnRenamed("event_date", "metric_date")
    replace_slices(spark, named, rows, root, "daily_metrics")


def refresh_daily_metrics(
    spark: SparkSession, root: str, ten: DataFrame, slices: DataFrame, as_of: Moment, **options
) -> None:
    """Recompute and replace the given (event_date, tenant_id) slices from the events, whatever day they are.

    For repairs; batches use :func:`refresh_from_ledger`. Only the listed days of the event table are read. A slice that has no
    event left is removed, in the same commit.
    """

    def rows(staged: DataFrame) -> DataFrame:
        staged = staged.withColumnRenamed("metric_date", "event_date")
        ev = read_table(spark, root, "job_events").filter(touched_days(staged, "event_date"))
        return daily_metrics(ev, ten, as_of, slices=staged, **options)

    named = slices.filter(F.col("event_date").isNotNull()).withColumnRenamed("event_date", "metric_date")
    replace_slices(spark, named, rows, root, "daily_metrics")
