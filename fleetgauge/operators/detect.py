"""Statistical detectors for all tenants at once.

Top-k reports rank before they join: inside one baseline group the order by z
is the order by cost, so the k rows a tenant can report are among the k
costliest rows of each of its groups. Only those reach the join, whatever the
size of the group. Asked for all findings at once, the detectors share one
baseline (:mod:`.baseline`).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.clock import Moment, between, clip, epoch_seconds, moment, stamp, today, trailing
from ..functions.numeric import from_units, hit, pct, ratio, real, rnd, units
from ..functions.quantiles import summarize
from ..functions.text import fixed, say, stable_id, usd
from ..functions.tiers import above
from ..settings import DetectorLimits, RuleLimits
from . import baseline

ANOMALY_COLUMNS = (
    "anomaly_id", "tenant_id", "job_id", "anomaly_type", "severity", "title", "description",
    "metric_value", "threshold_value", "recommended_action", "detected_at",
)


def top_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows per key; Spark trims to ``k`` per task before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def highest_per(df: DataFrame, keys: Sequence[str], value: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows with the highest ``value`` per key, ties by ``tie``, in one pass."""
    return top_per(df, keys, [F.col(value).desc_nulls_last(), F.col(tie).asc()], k)


def _fields(
    as_of: Moment, kind: str, subject: Column, *, job_id, severity, title, description, metric, threshold, action,
) -> list[Column]:
    """A finding in the common shape, from the columns of its detector."""
    day = F.lit(today(as_of).isoformat())
    return [
        stable_id(F.lit(kind), F.col("tenant_id"), subject, day).alias("anomaly_id"),
        F.col("tenant_id"),
        job_id.cast("string").alias("job_id"),
        F.lit(kind).alias("anomaly_type"),
        severity.alias("severity"),
        title.alias("title"),
        description.alias("description"),
        metric.cast("double").alias("metric_value"),
        threshold.cast("double").alias("threshold_value"),
        F.lit(action).alias("recommended_action"),
        stamp(as_of).alias("detected_at"),
    ]


def _spike(as_of: Moment, limits: DetectorLimits) -> list[Column]:
    return _fields(
        as_of, "COST_SPIKE", F.col("event_id"),
        job_id=F.col("job_id"),
        severity=above("z", (limits.z_critical, "CRITICAL"), otherwise="HIGH"),
        title=say(F.col("job_name"), " cost $", fixed("cost_usd", 2), ", ", fixed("z", 1), " deviations above its group"),
        description=say(F.col("job_id"), " (", F.col("job_type"), ", ", F.col("machine_type"),
                        ") cost $", fixed("cost_usd", 4), ": ", fixed("z", 1),
                        " deviations above the mean of $", fixed("mean_cost", 4),
                        " (deviation $", fixed("std_cost", 4), ")."),
        metric=rnd("cost_usd", 6),
        threshold=rnd(F.col("mean_cost") + F.lit(limits.z_flag) * F.col("std_cost"), 6),
        action="Check the job for more input, more replicas than meant, or an endless loop.",
    )


def _outlier(as_of: Moment, job_type: str = "job_type") -> list[Column]:
    seconds, fence = F.col("duration_seconds"), F.col("fence")
    return _fields(
        as_of, "DURATION_OUTLIER", F.col("event_id"),
        job_id=F.col("job_id"),
        severity=F.lit("MEDIUM"),
        title=say(F.col("job_name"), " ran ", fixed(seconds / F.lit(3600.0), 1), " hours, longer than usual"),
        description=say(F.col("job_id"), " (", F.col(job_type), ") took ", seconds, "s (",
                        fixed(seconds / F.lit(3600.0), 2), "h); the fence is ", fixed(fence, 0),
                        "s (", fixed(fence / F.lit(3600.0), 2), "h)."),
        metric=seconds,
        threshold=rnd(fence, 1),
        action="Check input volume, model changes and hardware; consider a job timeout.",
    )


def _burst(as_of: Moment, limits: DetectorLimits) -> list[Column]:
    return _fields(
        as_of, "FAILURE_BURST", F.date_format(stamp(as_of), "yyyy-MM-dd HH"),
        job_id=F.lit(None),
        severity=above("delta", (limits.burst_critical_points, "CRITICAL"), otherwise="HIGH"),
        title=say("Failures up ", fixed("delta", 1), " points within the hour"),
        description=say("Failures went from ", fixed("baseline_rate", 1), "% (baseline) to ",
                        fixed("recent_rate", 1), "% in the last hour (+", fixed("delta", 1),
                        " points)."),
        metric=rnd("recent_rate", 2),
        threshold=rnd(F.col("baseline_rate") + F.lit(limits.burst_points), 2),
        action="Act now: check infrastructure, recent deployments and input schema changes.",
    )


def _waste(as_of: Moment, limits: DetectorLimits) -> list[Column]:
    return _fields(
        as_of, "GPU_WASTE_PATTERN", F.lit("window"),
        job_id=F.lit(None),
        severity=F.lit("MEDIUM"),
        title=say(fixed("waste_pct", 0), "% of accelerator jobs ended within five minutes"),
        description=say(F.col("short_jobs"), "/", F.col("gpu_jobs"),
                        " GPU jobs ended within five minutes (", fixed("waste_pct", 1),
                        "%). Mean cost of such a job: ", usd("avg_wasted_cost", 4), "."),
        metric=rnd("waste_pct", 1),
        threshold=F.lit(limits.waste_flag_pct),
        action="Move very short jobs to machines without an accelerator.",
    )


def cost_baseline(
    ev: DataFrame, as_of: Moment, limits: DetectorLimits = DetectorLimits()
) -> DataFrame:
    """Mean and sample deviation of cost per tenant, job type and machine."""
    rows = clip(ev, **trailing(as_of, days=limits.baseline_days)).withColumn("cost_usd", real("cost_usd"))
    stats = rows.groupBy("tenant_id", "job_type", "machine_type").agg(
        F.count(F.lit(1)).alias("samples"),
        ratio(from_units(F.sum(units("cost_usd"))), F.count("cost_usd")).alias("mean_cost"),
        F.stddev_samp("cost_usd").alias("std_cost"),
    )
    return stats.filter(F.col("samples") >= limits.min_samples)


def cost_spikes(
    ev: DataFrame,
    as_of: Moment,
    window_hours: float = 24,
    limits: DetectorLimits = DetectorLimits(),
) -> DataFrame:
    """Jobs whose cost is more than ``z_flag`` deviations above their group's mean."""
    group = ["tenant_id", "job_type", "machine_type"]
    rows = clip(ev, **trailing(as_of, hours=window_hours)).withColumn("cost_usd", real("cost_usd"))
    rows = rows.filter(F.col("cost_usd").isNotNull())
    rows = rows.select("event_id", "job_id", "job_name", "cost_usd", *group)
    highest = highest_per(rows, group, "cost_usd", "event_id", limits.top_spikes)
    scored = highest.join(cost_baseline(ev, as_of, limits), group).withColumn(
        "z", F.try_divide(F.col("cost_usd") - F.col("mean_cost"), F.col("std_cost"))
    )
    flagged = scored.filter(F.col("z") > limits.z_flag)
    order = [F.col("z").desc(), F.col("cost_usd").desc(), F.col("event_id").asc()]
    flagged = top_per(flagged, ["tenant_id"], order, limits.top_spikes)
    return flagged.select(*_spike(as_of, limits), "event_id", rnd("z", 4).alias("z_score"))


def duration_fence(
    ev: DataFrame, as_of: Moment, limits: DetectorLimits = DetectorLimits(), approx: bool = False
) -> DataFrame:
    """Upper fence of durations per tenant: third quartile plus a multiple of the spread."""
    rows = clip(ev, **trailing(as_of, days=limits.baseline_days))
    q = summarize(
        rows, ["tenant_id"], {}, value="duration_seconds", at=(0.25, 0.75), approx=approx
    )
    q1, q3 = F.element_at("q", 1), F.element_at("q", 2)
    fences = q.select("tenant_id", q1.alias("q1"), q3.alias("q3"))
    spread = F.col("q3") - F.col("q1")
    fences = fences.withColumn("fence", F.col("q3") + F.lit(limits.fence_factor) * spread)
    return fences.filter(F.col("fence").isNotNull())


def duration_outliers(
    ev: DataFrame,
    as_of: Moment,
    window_hours: float = 24,
    limits: DetectorLimits = DetectorLimits(),
    approx: bool = False,
) -> DataFrame:
    """The longest recent jobs of each tenant that lie above its fence."""
    rows = clip(ev, **trailing(as_of, hours=window_hours))
    rows = rows.filter(F.col("duration_seconds").isNotNull()).select(
        "event_id", "tenant_id", "job_id", "job_name", "job_type", "duration_seconds"
    )
    longest = highest_per(rows, ["tenant_id"], "duration_seconds", "event_id", limits.top_outliers)
    flagged = longest.join(duration_fence(ev, as_of, limits, approx), "tenant_id")
    flagged = flagged.filter(F.col("duration_seconds") > F.col("fence"))
    return flagged.select(*_outlier(as_of), "event_id")


def failure_rates(
    ev: DataFrame, as_of: Moment, limits: DetectorLimits = DetectorLimits()
) -> DataFrame:
    """Failure share of the last hour and of the days before it, per tenant, in one scan.

    Both bounds of the baseline are strict: an event exactly one hour old is in neither.
    """
    end = moment(as_of)
    hour_ago = end - timedelta(hours=1)
    recent = between("started_at", after=hour_ago)
    baseline = between("started_at", before=hour_ago)
    failed = F.col("status") == "FAILED"
    counts = clip(ev, **trailing(as_of, days=limits.baseline_days)).groupBy("tenant_id").agg(
        F.sum(hit(recent)).alias("recent_jobs"),
        F.sum(hit(recent & failed)).alias("recent_failed"),
        F.sum(hit(baseline)).alias("baseline_jobs"),
        F.sum(hit(baseline & failed)).alias("baseline_failed"),
    )
    rates = counts.withColumns(
        {
            "recent_rate": pct("recent_failed", "recent_jobs"),
            "baseline_rate": pct("baseline_failed", "baseline_jobs"),
        }
    )
    return rates.withColumn("delta", F.col("recent_rate") - F.col("baseline_rate"))


def failure_bursts(
    ev: DataFrame, as_of: Moment, limits: DetectorLimits = DetectorLimits()
) -> DataFrame:
    """Tenants whose failure share rose by more than ``burst_points``."""
    flagged = failure_rates(ev, as_of, limits).filter(F.col("delta") > limits.burst_points)
    return flagged.select(*_burst(as_of, limits))


def gpu_waste_rates(
    ev: DataFrame,
    as_of: Moment,
    window_hours: float = 24,
    limits: DetectorLimits = DetectorLimits(),
) -> DataFrame:
    """Share of accelerator jobs that ended almost at once, and their mean cost, per tenant."""
    rows = clip(ev, **trailing(as_of, hours=window_hours)).filter(F.col("gpu_count") > 0)
    short = F.col("duration_seconds") < limits.short_job_seconds
    spent = from_units(F.sum(F.when(short, units("cost_usd"))))
    return rows.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("gpu_jobs"),
        F.sum(hit(short)).alias("short_jobs"),
        pct(F.sum(hit(short)), F.count(F.lit(1))).alias("waste_pct"),
        F.coalesce(
            ratio(spent, F.count(F.when(short, real("cost_usd")))), F.lit(0.0)
        ).alias("avg_wasted_cost"),
    )


def _wasteful(limits: DetectorLimits) -> Column:
    return (F.col("gpu_jobs") >= limits.min_samples) & (F.col("waste_pct") >= limits.waste_flag_pct)


def gpu_waste_pattern(
    ev: DataFrame,
    as_of: Moment,
    window_hours: float = 24,
    limits: DetectorLimits = DetectorLimits(),
) -> DataFrame:
    """Tenants with enough accelerator jobs of which too many ended almost at once."""
    rates = gpu_waste_rates(ev, as_of, window_hours, limits)
    flagged = rates.filter(_wasteful(limits))
    return flagged.select(*_waste(as_of, limits), "gpu_jobs", "short_jobs", "avg_wasted_cost")


def all_anomalies(
    ev: DataFrame,
    as_of: Moment,
    window_hours: float = 24,
    limits: DetectorLimits = DetectorLimits(),
    approx: bool = False,
) -> DataFrame:
    """Findings of all four detectors in the common shape.

    Two scans: one fills the shared baseline, one finds the candidates of the window. They
    are dealt by the same keys, so the join between them moves nothing. ``approx`` asks each detector by itself, since
    sketches cannot be weighted.
    """
    if approx:
        found = [
            cost_spikes(ev, as_of, window_hours, limits),
            duration_outliers(ev, as_of, window_hours, limits, approx),
            failure_bursts(ev, as_of, limits),
            gpu_waste_pattern(ev, as_of, window_hours, limits),
        ]
        result = found[0].select(*ANOMALY_COLUMNS)
        for df in found[1:]:
            result = result.unionByName(df.select(*ANOMALY_COLUMNS))
        return result
    base = baseline.measured(ev, as_of, window_hours, limits)
    tops = baseline.candidates(ev, as_of, window_hours, limits).withColumnRenamed("job_type", "cand_type")
    on = [base[c] == tops[f"of_{c}"] for c in baseline.KEYS]
    rows = base.join(tops, on, "left").withColumns(
        {
            "z": F.try_divide(F.col("cost_usd") - F.col("mean_cost"), F.col("std_cost")),
            "delta": F.col("recent_rate") - F.col("baseline_rate"),
        }
    )
    group, per_tenant = F.col("level") == baseline.GROUP, F.col("level") == baseline.TENANT
    once = per_tenant & F.coalesce(F.col("nth") == 1, F.lit(True))  # what is about the tenant, not about a job
    tests = [
        (group & (F.col("samples") >= limits.min_samples) & (F.col("z") > limits.z_flag), _spike(as_of, limits)),
        (per_tenant & (F.col("duration_seconds") > F.col("fence")), _outlier(as_of, "cand_type")),
        (once & (F.col("delta") > limits.burst_points), _burst(as_of, limits)),
        (once & _wasteful(limits), _waste(as_of, limits)),
    ]
    found = F.array_compact(F.array(*[F.when(test, F.struct(*fields)) for test, fields in tests]))
    found = rows.select("z", "cost_usd", "event_id", F.explode(found).alias("f")).select("z", "cost_usd", "event_id", "f.*")
    order = [F.col("z").desc(), F.col("cost_usd").desc(), F.col("event_id").asc()]
    nth = F.row_number().over(W.partitionBy("tenant_id", "anomaly_type").orderBy(*order))
    kept = (F.col("anomaly_type") != "COST_SPIKE") | (nth <= limits.top_spikes)
    return found.withColumn("_kept", kept).filter("_kept").select(*ANOMALY_COLUMNS)


def rolling_duration_baseline(ev: DataFrame, days: int = 7) -> DataFrame:
    """Mean duration over the ``days`` before each second, per tenant and job type.

    The frame ``[t - days, t - 1 s]`` is the difference of two running sums,
    the one before ``t`` and the one before ``t - days``. A range window over
    events would sort a whole tenant in one task and re-add the frame for
    every row. Here events are first added up per second, and a running sum
    has two parts: the days before (one row per day) and the seconds before
    within the day, of which there are at most 86,400 however many events
    there are. Each second brings a second row, a probe at ``t - days`` that
    adds nothing and reads the earlier running sum.
    """
    keys = ["tenant_id", "job_type"]
    zero = F.lit(0).cast("bigint")
    seconds = (
        ev.filter(F.col("duration_seconds").isNotNull() & F.col("started_at").isNotNull())
        .groupBy(*keys, epoch_seconds("started_at").alias("sec"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("duration_seconds").cast("bigint")).alias("total"),
            F.max("duration_seconds").alias("longest"),
        )
    )
    both = F.array(
        F.struct(F.col("sec").alias("at"), F.lit(1).alias("sign"), F.col("n").alias("n"),
                 F.col("total").alias("total")),
        F.struct((F.col("sec") - F.lit(days * 86400)).alias("at"), F.lit(-1).alias("sign"),
                 zero.alias("n"), zero.alias("total")),
    )
    swept = seconds.select(*keys, "sec", "longest", F.inline(both))
    swept = swept.withColumn("day", F.expr("at div 86400"))
    # Strictly earlier rows of the day; a probe (sign -1) sorts ahead of the
    # second it falls on, so that second stays inside the frame.
    earlier = W.partitionBy(*keys, "day").orderBy("at", "sign").rowsBetween(W.unboundedPreceding, -1)
    within = swept.select(
        *keys, "day", "sec", "sign", "longest",
        F.coalesce(F.sum("n").over(earlier), zero).alias("n_within"),
        F.coalesce(F.sum("total").over(earlier), zero).alias("total_within"),
    )
    per_day = swept.groupBy(*keys, "day").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    before = W.partitionBy(*keys).orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    days_before = per_day.select(
        *keys, "day",
        F.coalesce(F.sum("n").over(before), zero).alias("n_before"),
        F.coalesce(F.sum("total").over(before), zero).alias("total_before"),
    )
    running = within.join(days_before, [*keys, "day"])
    frames = running.groupBy(*keys, "sec").agg(
        F.sum(F.col("sign") * (F.col("n_before") + F.col("n_within"))).alias("baseline_jobs"),
        F.sum(F.col("sign") * (F.col("total_before") + F.col("total_within"))).alias("_total"),
        F.max("longest").alias("longest"),
    )
    return frames.select(
        *keys, "sec", "longest", "baseline_jobs",
        ratio("_total", "baseline_jobs").alias("baseline_seconds"),
    )


def latency_spikes_rolling(
    ev: DataFrame, days: int = 7, factor: float = RuleLimits().spike_factor
) -> DataFrame:
    """Jobs that took more than ``factor`` times their rolling mean duration."""
    keys = ["tenant_id", "job_type"]
    base = rolling_duration_baseline(ev, days)
    # Only seconds whose longest job qualifies take part in the join back.
    base = base.filter(F.col("longest") > F.lit(factor) * F.col("baseline_seconds")).drop("longest")
    rows = ev.select("event_id", *keys, "started_at", "duration_seconds")
    rows = rows.withColumn("sec", epoch_seconds("started_at"))
    hits = rows.join(base, [*keys, "sec"])
    hits = hits.filter(F.col("duration_seconds") > F.lit(factor) * F.col("baseline_seconds"))
    return hits.select(
        "event_id", *keys, "started_at", "duration_seconds", "baseline_jobs",
        rnd("baseline_seconds", 2).alias("baseline_seconds"),
        rnd(ratio("duration_seconds", "baseline_seconds"), 3).alias("times_baseline"),
    )
