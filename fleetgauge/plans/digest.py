"""Digest datasets and their text, one row per tenant."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import Moment, between, calendar_day, clip, stamp, today, trailing
from ..functions.numeric import from_units, hit, hours, pct, ratio, real, rnd, units
from ..functions.quantiles import summarize
from ..functions.text import fixed, say, shown, stable_id, usd
from ..functions.tiers import budget_label, severity_rank
from ..operators.detect import top_per
from .finance import budget_status
from .measures import zero


def digest_snapshot(ev: DataFrame, inc: DataFrame, ten: DataFrame, as_of: Moment) -> DataFrame:
    """Incidents and jobs of the last 24 hours."""
    day = trailing(as_of, hours=24)
    incidents = clip(inc, "detected_at", **day).groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("inc_n"), F.sum(units("metric_value")).alias("metric_u")
    )
    jobs = clip(ev, **day).groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("jobs_n"), F.sum(units("cost_usd")).alias("cost_u")
    )
    rows = ten.select("tenant_id").join(incidents, "tenant_id", "left").join(jobs, "tenant_id", "left")
    return rows.select(
        "tenant_id",
        zero("inc_n").alias("incidents_24h"),
        F.coalesce(from_units("metric_u"), F.lit(0.0)).alias("incident_metric_sum"),
        zero("jobs_n").alias("jobs_24h"),
        F.coalesce(from_units("cost_u"), F.lit(0.0)).alias("cost_24h"),
    )


def digest_rows(
    ev: DataFrame, inc: DataFrame, ten: DataFrame, as_of: Moment, period: str = "DAILY"
) -> DataFrame:
    """Digest records: stable id, day, counts, cost, budget status, plain summary sentence."""
    snap = digest_snapshot(ev, inc, ten, as_of)
    status = budget_status(ev, ten, as_of).select("tenant_id", "pct_used")
    day = F.lit(today(as_of))
    return snap.join(status, "tenant_id", "left").select(
        stable_id(F.col("tenant_id"), day, F.lit(period)).alias("digest_id"),
        "tenant_id",
        day.alias("digest_date"),
        F.lit(period).alias("period"),
        say("[", F.col("tenant_id"), f"] {period} digest: ", F.col("jobs_24h"), " jobs in 24h, $",
            fixed("cost_24h", 2), " cost, ", F.col("incidents_24h"), " incidents.")
        .alias("summary_text"),
        F.col("incidents_24h").alias("incidents_count"),
        F.col("cost_24h").alias("total_cost_usd"),
        budget_label("pct_used", code=True).alias("budget_status"),
        stamp(as_of).alias("generated_at"),
    )


def digest_daily_metrics(
    ev: DataFrame, inc: DataFrame, ten: DataFrame, as_of: Moment, approx: bool = False
) -> DataFrame:
    """The 14 numbers of a daily digest, from one scan of the last seven days."""
    day = between("started_at", **calendar_day(as_of))
    ok, failed = F.col("status") == "SUCCEEDED", F.col("status") == "FAILED"
    one = F.lit(1) == F.lit(1)
    measures = {
        "week_n": hit(one), "week_ok": hit(ok), "week_u": units("cost_usd"),
        "day_n": hit(day), "day_ok": hit(day & ok), "day_failed": hit(day & failed),
        "day_u": F.when(day, units("cost_usd")),
        "day_cost_n": hit(day & real("cost_usd").isNotNull()),
        "day_gpu_u": F.when(day, units("gpu_hours")),
        "day_cpu_u": F.when(day, units("cpu_hours")),
    }
    jobs = summarize(
        clip(ev, **calendar_day(as_of, days=7)), ["tenant_id"], measures,
        value="duration_seconds", at=(0.95,), counted=day, approx=approx,
    )
    still_open = inc.filter(F.col("status") == "OPEN").groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("open_n")
    )
    rows = ten.select("tenant_id", "budget_weekly").join(jobs, "tenant_id", "left")
    rows = rows.join(still_open, "tenant_id", "left")
    week = F.coalesce(from_units("week_u"), F.lit(0.0))
    spent = F.coalesce(from_units("day_u"), F.lit(0.0))
    return rows.select(
        "tenant_id",
        rnd(spent, 4).alias("spend_today"),
        rnd(week, 4).alias("spend_week"),
        rnd(pct(week, "budget_weekly"), 2).alias("budget_pct_used"),
        rnd(week / F.lit(7.0) * F.lit(30.0), 2).alias("monthly_projection"),
        zero("day_n").alias("total_jobs_today"),
        zero("day_ok").alias("succeeded_today"),
        zero("day_failed").alias("failed_today"),
        rnd(pct("day_ok", "day_n"), 2).alias("success_rate_today"),
        rnd(pct("week_ok", "week_n"), 2).alias("success_rate_7d"),
        hours(F.element_at("q", 1), 2).alias("p95_hours_today"),
        rnd(ratio(from_units("day_u"), "day_cost_n"), 4).alias("avg_cost_today"),
        rnd(F.coalesce(from_units("day_gpu_u"), F.lit(0.0)), 2).alias("gpu_hours_today"),
        rnd(F.coalesce(from_units("day_cpu_u"), F.lit(0.0)), 2).alias("cpu_hours_today"),
        zero("open_n").alias("open_incidents"),
    )


def digest_weekly_metrics(ev: DataFrame, inc: DataFrame, ten: DataFrame, as_of: Moment) -> DataFrame:
    """The 17 values of a weekly digest: per-day sums first, then one row per tenant."""
    week = calendar_day(as_of, days=7)
    gpu = F.col("gpu_count") > 0
    daily = summarize(
        clip(ev, **week).withColumn("day", F.to_date("started_at")), ["tenant_id", "day"],
        {
            "n": F.lit(1).cast("bigint"),
            "ok": hit(F.col("status") == "SUCCEEDED"),
            "bad": hit(F.col("status") == "FAILED"),
            "cost_u": F.coalesce(units("cost_usd"), F.lit(0)),
            "gpu_cost_u": F.when(gpu, units("cost_usd")),
            "gpu_u": units("gpu_hours"),
            "cpu_u": units("cpu_hours"),
        },
    )
    number = F.unix_date("day")
    sums = ("n", "ok", "bad", "cost_u", "gpu_cost_u", "gpu_u", "cpu_u")
    weekly = daily.groupBy("tenant_id").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.max_by("day", F.struct("cost_u", -number)).alias("peak_day"),
        F.max("cost_u").alias("peak_u"),
        F.min_by("day", F.struct(F.col("cost_u"), number)).alias("trough_day"),
        F.min("cost_u").alias("trough_u"),
    )
    found = clip(inc, "detected_at", **week).groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("inc_n"),
        F.sum(hit(F.col("severity") == "CRITICAL")).alias("inc_critical"),
        F.sum(hit(F.col("severity") == "HIGH")).alias("inc_high"),
    )
    rows = ten.select("tenant_id", "budget_weekly").join(weekly, "tenant_id", "left")
    rows = rows.join(found, "tenant_id", "left")
    spend = F.coalesce(from_units("cost_u"), F.lit(0.0))
    amount = lambda c: rnd(F.coalesce(from_units(c), F.lit(0.0)), 2)
    return rows.select(
        "tenant_id",
        rnd(spend, 4).alias("spend_week"),
        rnd(pct(spend, "budget_weekly"), 2).alias("budget_pct_used"),
        rnd(F.greatest(F.col("budget_weekly") - spend, F.lit(0.0)), 4).alias("budget_remaining"),
        amount("gpu_u").alias("gpu_hours_week"),
        amount("cpu_u").alias("cpu_hours_week"),
        rnd(pct(F.coalesce("gpu_cost_u", F.lit(0)), "cost_u"), 2).alias("gpu_cost_pct"),
        zero("n").alias("total_jobs_week"),
        zero("ok").alias("succeeded_week"),
        zero("bad").alias("failed_week"),
        rnd(pct("ok", "n"), 2).alias("success_rate_week"),
        "peak_day",
        rnd(from_units("peak_u"), 4).alias("peak_day_cost"),
        "trough_day",
        rnd(from_units("trough_u"), 4).alias("trough_day_cost"),
        zero("inc_n").alias("incidents_total"),
        zero("inc_critical").alias("incidents_critical"),
        zero("inc_high").alias("incidents_high"),
    )


# The line layout of the digest text. A line is a label and the
# metric behind it with its format, or several of them; a string alone is a heading.
DAILY_LINES = (
    "## Spend & budget",
    ("Spend today", "usd", "spend_today"),
    ("Spend (7d)", "usd", "spend_week"),
    ("Weekly budget", "usd", "budget_weekly"),
    ("Daily budget (prorated)", "usd", "budget_daily"),
    ("Budget % used (rolling)", "percent", "budget_pct_used"),
    ("Monthly projection", "usd", "monthly_projection"),
    "## Jobs (24h)",
    ("Total jobs", "plain", "total_jobs_today"),
    ("SUCCEEDED", "plain", "succeeded_today"),
    ("Failed", "plain", "failed_today"),
    ("Success rate today", "percent", "success_rate_today"),
    ("Success rate (7d)", "percent", "success_rate_7d"),
    ("p95 duration (h)", "two", "p95_hours_today"),
    ("Avg cost / job", "usd", "avg_cost_today"),
    "## Utilization",
    ("GPU hours", "one", "gpu_hours_today"),
    ("CPU hours", "one", "cpu_hours_today"),
    "## Incidents",
    ("Open incidents", "plain", "open_incidents"),
)
WEEKLY_LINES = (
    "## Spend",
    ("Spend (week)", "usd", "spend_week"),
    ("Weekly budget", "usd", "budget_weekly"),
    ("Budget % used", "percent", "budget_pct_used"),
    ("Budget remaining", "usd", "budget_remaining"),
    "## Utilization",
    ("GPU hours (week)", "one", "gpu_hours_week"),
    ("CPU hours (week)", "one", "cpu_hours_week"),
    ("GPU share of cost", "percent", "gpu_cost_pct"),
    "## Jobs",
    ("Total jobs", "plain", "total_jobs_week"),
    ("SUCCEEDED (week)", "plain", "succeeded_week"),
    ("Failed (week)", "plain", "failed_week"),
    ("Success rate", "percent", "success_rate_week"),
    "## Peaks",
    ("Peak day", "day_cost", "peak_day"),
    ("Trough day", "day_cost", "trough_day"),
    "## Incidents (week)",
    (("Total", "plain", "incidents_total"), ("CRITICAL", "plain", "incidents_critical"), ("HIGH", "plain", "incidents_high")),
)
LIST_HEADS = {"DAILY": "- Recent incidents (severity / type / title):", "WEEKLY": "- Detail:"}


def _line(spec) -> list[Column]:
    if isinstance(spec, str):
        return [F.lit(""), F.lit(spec)]
    items = [spec] if isinstance(spec[0], str) else spec
    parts: list[Column | str] = []
    for label, form, name in items:
        value = {
            "usd": lambda: usd(name),
            "percent": lambda: F.concat(fixed(name, 1), F.lit("%")),
            "one": lambda: fixed(name, 1),
            "two": lambda: fixed(name, 2),
            "plain": lambda: shown(name),
            "day_cost": lambda: F.concat(shown(name), F.lit(" ("), usd(f"{name}_cost"), F.lit(")")),
        }[form]()
        parts += [f", {label}: " if parts else f"- {label}: ", value]
    return [say(*parts)]


def _head(as_of: Moment, period: str) -> list[Column]:
    day = today(as_of)
    if period == "DAILY":
        when = f"Digest date: {day.isoformat()}"
    else:
        when = f"Week window: {(day - timedelta(days=6)).isoformat()} through {day.isoformat()}"
    return [say("Tenant: ", F.col("display_name")), F.lit(when)]


CLOSE = ("", "Answer with the JSON object described for digests, citing these numbers.")
#: Parts of a digest in order: fixed lines, heading of the list, incidents, the close.
FIXED, LISTED, INCIDENT, CLOSING = range(4)
#: What puts the lines of a digest in order.
ORDER = ("tenant_id", "part", "position", "age", "incident_id")


def _recent(inc: DataFrame, as_of: Moment, period: str) -> DataFrame:
    """Incidents of the period as lines, with what puts the worst and newest first."""
    window = trailing(as_of, hours=24) if period == "DAILY" else calendar_day(as_of, days=7)
    title = F.col("title") if "title" in inc.columns else F.col("incident_type")
    return clip(inc, "detected_at", **window).select(
        "tenant_id", "incident_id",
        severity_rank("severity").cast("int").alias("position"),
        (-F.coalesce(F.unix_micros(F.col("detected_at").cast("timestamp")), F.lit(0))).alias("age"),
        F.concat(F.lit("  - "), shown("severity"), F.lit(": "), shown("incident_type"), F.lit(" — "), shown(title)).alias("line"),
    )


def digest_lines(metrics: DataFrame, inc: DataFrame, ten: DataFrame, as_of: Moment, period: str = "DAILY") -> DataFrame:
    """The whole digest as rows (tenant_id, part, position, age, incident_id, line), in the order of ``ORDER``.

    Every incident of the period is a row of its own, so no tenant's digest is ever in one place.
    """
    rows = ten.select("tenant_id", "display_name", "budget_weekly").join(metrics, "tenant_id")
    rows = rows.withColumn("budget_daily", F.col("budget_weekly") / F.lit(7.0))
    body = [c for spec in (DAILY_LINES if period == "DAILY" else WEEKLY_LINES) for c in _line(spec)]
    texts = {FIXED: [*_head(as_of, period), *body], CLOSING: [F.lit(x) for x in CLOSE]}
    lines = [
        F.struct(F.lit(part).alias("part"), F.lit(i).alias("position"), text.alias("line"))
        for part, column in texts.items() for i, text in enumerate(column)
    ]
    none = {"age": F.lit(0).cast("bigint"), "incident_id": F.lit("")}
    fixed_rows = rows.select("tenant_id", F.inline(F.array(*lines))).withColumns(none)
    recent = _recent(inc, as_of, period).join(ten.select("tenant_id"), "tenant_id", "left_semi").withColumn("part", F.lit(INCIDENT))
    heads = recent.select("tenant_id").distinct().withColumns(
        {"part": F.lit(LISTED), "position": F.lit(0), "line": F.lit(LIST_HEADS[period]), **none}
    )
    columns = [*ORDER, "line"]
    return fixed_rows.select(columns).unionByName(heads.select(columns)).unionByName(recent.select(columns))


def write_digest_texts(lines: DataFrame, path: str) -> None:
    """Text files per tenant; read in the order of their names they are the digest.

    Lines are dealt by range of their order, so a tenant with many incidents is written by many tasks,
    each its own segment of the text.
    """
    dealt = lines.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    dealt.select("tenant_id", "line").write.mode("overwrite").partitionBy("tenant_id").text(path)


def render_digest(
    metrics: DataFrame,
    inc: DataFrame,
    ten: DataFrame,
    as_of: Moment,
    period: str = "DAILY",
    top: int = 20,
) -> DataFrame:
    """One digest text per tenant with the ``top`` worst incidents; a last line counts the others.

    For messages. :func:`digest_lines` gives all incidents, as rows.
    """
    recent = _recent(inc, as_of, period)
    order = [F.col("position"), F.col("age"), F.col("incident_id")]
    worst = top_per(recent, ["tenant_id"], order, top)
    listed = worst.groupBy("tenant_id").agg(
        F.sort_array(F.collect_list(F.struct("position", "age", "incident_id", "line"))).alias("items")
    )
    counted = recent.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("recent_n"))
    rows = (
        ten.select("tenant_id", "display_name", "budget_weekly")
        .join(metrics, "tenant_id").join(listed, "tenant_id", "left")
        .join(counted, "tenant_id", "left")
        .withColumn("budget_daily", F.col("budget_weekly") / F.lit(7.0))
    )
    body = [c for spec in (DAILY_LINES if period == "DAILY" else WEEKLY_LINES) for c in _line(spec)]
    lines = F.transform("items", lambda x: x["line"])
    listing = F.when(
        F.size("items") > 0, F.concat(F.array(F.lit(LIST_HEADS[period])), lines)
    ).otherwise(F.array().cast("array<string>"))
    hidden = F.col("recent_n") - F.lit(top)
    more = F.when(hidden > 0, F.array(say("  - and ", hidden, " more"))).otherwise(
        F.array().cast("array<string>")
    )
    close = F.array(*[F.lit(x) for x in CLOSE])
    return rows.select(
        "tenant_id",
        F.lit(today(as_of)).alias("digest_date"),
        F.lit(period).alias("period"),
        F.concat_ws("\n", F.array(*_head(as_of, period), *body), F.coalesce(listing, F.array().cast("array<string>")), more, close)
        .alias("digest_text"),
    )
