"""What all detectors compare with, from one pass over the events.

Events are first added up per tenant, job type, machine and whole second of duration: counts, exact sums and
sums of squares of cost, failures, short jobs. Such rows can be added to each other, so means, deviations, fences and
rates are all derived from them, and a tenant with a third of all events is spread by second. A second
aggregation adds them up twice, per group (costs) and per tenant (durations, rates), in one shuffle.

Squares are exact whole numbers. With u millionths of cost in two parts, u = a * 2^24 + b, the square is
a^2 * 2^48 + c * 2^24 + d with c = 2ab + b^2 >> 24 and d = b^2 mod 2^24; the three are added as BIGINT, in generated
code. Deviations are taken about the whole part of the mean, so nothing cancels. Sums beyond BIGINT fail
loudly, as all sums of amounts do.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import Moment, between, clip, moment, trailing
from ..functions.numeric import from_units, hit, pct, ratio, real, units
from ..settings import DetectorLimits

GROUP, TENANT = "group", "tenant"
KEYS = ("level", "tenant_id", "job_type", "machine_type")
_LOW = (1 << 24) - 1


def _squares(u: Column) -> dict[str, Column]:
    """The parts of u * u, to be added up."""
    a, b = F.shiftright(u, 24), u.bitwiseAND(F.lit(_LOW))
    return {
        "sq_a": a * a,
        "sq_c": F.lit(2) * a * b + F.shiftright(b * b, 24),
        "sq_d": (b * b).bitwiseAND(F.lit(_LOW)),
    }


def _deviation() -> Column:
    """Sample deviation of cost from cost_n, cost_u and the parts of the squares."""
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    base = F.floor(F.col("cost_u") / F.col("cost_n")).cast("decimal(38,0)")
    squares = whole("sq_a") * F.lit(1 << 48).cast("decimal(38,0)") + whole("sq_c") * F.lit(1 << 24).cast("decimal(38,0)") + whole("sq_d")
    about = squares - F.lit(2).cast("decimal(38,0)") * base * whole("cost_u") + whole("cost_n") * base * base
    rest = (whole("cost_u") - whole("cost_n") * base).cast("double")
    spread = about.cast("double") - rest * rest / F.col("cost_n")
    return F.when(F.col("cost_n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("cost_n") - 1)) / F.lit(1e6))


def histogram(ev: DataFrame, as_of: Moment, window_hours: float, limits: DetectorLimits) -> DataFrame:
    """Additive measures per tenant, job type, machine and second of duration."""
    days, end = timedelta(days=limits.baseline_days), moment(as_of)
    window = timedelta(hours=window_hours)
    rows = clip(ev, after=end - max(days, window), until=end)
    in_base = between("started_at", after=end - days)
    in_window = between("started_at", after=end - window)
    hour_ago = end - timedelta(hours=1)
    recent, before = between("started_at", after=hour_ago), in_base & between("started_at", before=hour_ago)
    failed, cost = F.col("status") == "FAILED", F.when(in_base, units("cost_usd"))
    gpu = in_window & (F.col("gpu_count") > 0)
    short = gpu & (F.col("duration_seconds") < limits.short_job_seconds)
    measures = {
        "samples": hit(in_base), "cost_n": hit(cost.isNotNull()), "cost_u": cost, **_squares(cost),
        "recent_jobs": hit(recent), "recent_failed": hit(recent & failed),
        "baseline_jobs": hit(before), "baseline_failed": hit(before & failed),
        "gpu_jobs": hit(gpu), "short_jobs": hit(short),
        "short_u": F.when(short, units("cost_usd")), "short_n": hit(short & real("cost_usd").isNotNull()),
    }
    keys = ("tenant_id", "job_type", "machine_type", "duration_seconds")
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in measures.items()])


def measured(ev: DataFrame, as_of: Moment, window_hours: float = 24, limits: DetectorLimits = DetectorLimits()) -> DataFrame:
    """A row per group (mean, deviation) and one per tenant (fence, rates), told apart by ``level``."""
    seconds = F.col("duration_seconds")
    levels = F.array(
        F.struct(F.lit(GROUP).alias("level"), F.col("job_type").alias("j"), F.col("machine_type").alias("m"), F.lit(None).cast("int").alias("s")),
        F.struct(F.lit(TENANT).alias("level"), F.lit("").alias("j"), F.lit("").alias("m"), seconds.alias("s")),
    )
    rows = histogram(ev, as_of, window_hours, limits)
    sums = [c for c in rows.columns if c not in ("tenant_id", "job_type", "machine_type", "duration_seconds")]
    rows = rows.select("tenant_id", *sums, F.inline(levels))
    rows = rows.groupBy("level", "tenant_id", F.col("j").alias("job_type"), F.col("m").alias("machine_type")).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.percentile("s", [0.25, 0.75], F.col("samples")).alias("q"),
    )
    q1, q3 = F.element_at("q", 1), F.element_at("q", 2)
    return rows.select(
        *KEYS, "samples", "gpu_jobs", "short_jobs",
        ratio(from_units("cost_u"), "cost_n").alias("mean_cost"),
        _deviation().alias("std_cost"),
        (q3 + F.lit(limits.fence_factor) * (q3 - q1)).alias("fence"),
        pct("recent_failed", "recent_jobs").alias("recent_rate"),
        pct("baseline_failed", "baseline_jobs").alias("baseline_rate"),
        pct("short_jobs", "gpu_jobs").alias("waste_pct"),
        F.coalesce(ratio(from_units("short_u"), "short_n"), F.lit(0.0)).alias("avg_wasted_cost"),
    )


def candidates(ev: DataFrame, as_of: Moment, window_hours: float = 24, limits: DetectorLimits = DetectorLimits()) -> DataFrame:
    """The costliest jobs of each group and the longest of each tenant, from one scan.

    Each job stands for both; ``row_number() <= k`` trims to k rows a key and task before the shuffle.
    """
    rows = clip(ev, **trailing(as_of, hours=window_hours)).withColumn("cost_usd", real("cost_usd"))
    named = F.col("job_type").isNotNull() & F.col("machine_type").isNotNull()
    as_group = F.struct(
        F.lit(GROUP).alias("level"), F.col("job_type").alias("j"), F.col("machine_type").alias("m"), F.col("cost_usd").alias("v")
    )
    as_tenant = F.struct(
        F.lit(TENANT).alias("level"), F.lit("").alias("j"), F.lit("").alias("m"), F.col("duration_seconds").cast("double").alias("v")
    )
    both = F.array_compact(
        F.array(
            F.when(named & F.col("cost_usd").isNotNull(), as_group), F.when(F.col("duration_seconds").isNotNull(), as_tenant)
        )
    )
    own = ("event_id", "job_id", "job_name", "cost_usd", "duration_seconds", "job_type")
    rows = rows.select(F.col("tenant_id").alias("of_tenant_id"), *own, F.inline(both))
    rows = rows.withColumnsRenamed({"level": "of_level", "j": "of_job_type", "m": "of_machine_type"})
    w = W.partitionBy(*[f"of_{c}" for c in KEYS]).orderBy(F.col("v").desc(), F.col("event_id").asc())
    rows = rows.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= max(limits.top_spikes, limits.top_outliers))
    enough = F.when(F.col("of_level") == GROUP, F.lit(limits.top_spikes)).otherwise(F.lit(limits.top_outliers))
    return rows.filter(F.col("nth") <= enough).drop("v")
