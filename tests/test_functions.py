from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fleetgauge.functions import clock, numeric, text, tiers
from fleetgauge.functions.quantiles import summarize


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


def test_rounding_is_half_up_on_the_binary_value(spark):
    row = one(spark, numeric.rnd(F.lit(1.005), 2), numeric.rnd(F.lit(2.25), 1), numeric.rnd(F.lit(-1.0), 2))
    assert tuple(row) == (1.0, 2.3, -1.0)


def test_units_are_exact_and_skip_nan(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (float("nan"),), (None,)], "c double")
    row = df.agg(numeric.from_units(F.sum(numeric.units("c")))).first()
    assert row[0] == 0.3


def test_ratio_of_nothing_is_null(spark):
    assert tuple(one(spark, numeric.pct(F.lit(0), F.lit(0)), numeric.ratio(F.lit(1), F.lit(0)))) == (None, None)


def test_today_closes_the_day_before_at_midnight():
    assert clock.today("2024-01-31 00:00:00") == date(2024, 1, 30)
    assert clock.today(datetime(2024, 1, 31, 0, 0, 1)) == date(2024, 1, 31)
    assert clock.today(date(2024, 1, 31)) == date(2024, 1, 30)


def test_minutes_count_boundaries(spark):
    row = one(
        spark,
        clock.minutes_between(ts("2024-01-01 00:00:59"), ts("2024-01-01 00:01:01")),
        clock.minutes_between(ts("2024-01-01 00:01:00"), ts("2024-01-01 00:01:59")),
        clock.minutes_between(ts("2023-12-31 23:59:00"), ts("2024-01-01 00:00:00")),
    )
    assert tuple(row) == (1, 0, 1)


def test_weekday_and_week(spark):
    row = one(
        spark,
        clock.weekday(ts("2024-01-07 10:00:00")),  # a Sunday
        clock.weekday(ts("2024-01-08 10:00:00")),
        clock.week_start(ts("2024-01-07 10:00:00")),
        clock.epoch_seconds(ts("1970-01-02 00:00:01")),
    )
    assert tuple(row) == (0, 1, date(2024, 1, 1), 86401)


def test_clip_states_the_range_on_the_date_companion(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 5, 1), date(2024, 1, 5))], "started_at timestamp_ntz, event_date date"
    )
    kept = clock.clip(df, after="2024-01-05 00:00:00", until="2024-01-06 00:00:00")
    assert kept.count() == 1
    assert "event_date" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_text_helpers(spark):
    row = one(
        spark,
        text.usd(F.lit(1234.5)),
        text.usd(F.lit(None).cast("double")),
        text.fixed(F.lit(2.345), 1),
        text.fixed(F.lit(None).cast("double"), 1),
        text.clipped(F.lit("abcdef"), 3, "…"),
        text.clipped(F.lit("abc"), 3, "…"),
        text.clipped(F.lit("abcdef"), 4),
        text.say("a", F.lit(None).cast("string"), "b"),
    )
    assert tuple(row) == ("$1,234.50", "n/a", "2.3", "n/a", "abc…", "abc", "abcd", "an/ab")


def test_stable_id_depends_on_every_part(spark):
    row = one(
        spark,
        text.stable_id(F.lit("a"), F.lit("b")),
        text.stable_id(F.lit("a"), F.lit("b")),
        text.stable_id(F.lit("a"), F.lit(None).cast("string")),
    )
    assert row[0] == row[1] != row[2] and len(row[0]) == 64


@pytest.mark.parametrize(
    "pct, label, code",
    [(79.99, "On track", "ON_TRACK"), (80.0, "At risk", "AT_RISK"), (99.99, "At risk", "AT_RISK"),
     (100.0, "Over budget", "OVER_BUDGET"), (None, "On track", "ON_TRACK")],
)
def test_budget_ladder(spark, pct, label, code):
    c = F.lit(pct).cast("double")
    assert tuple(one(spark, tiers.budget_label(c), tiers.budget_label(c, code=True))) == (label, code)


@pytest.mark.parametrize("pct, tier", [(120.0, "MEDIUM"), (120.1, "HIGH"), (150.0, "HIGH"), (150.1, "CRITICAL")])
def test_spend_ladder(spark, pct, tier):
    assert one(spark, tiers.spend_severity(F.lit(pct)))[0] == tier


def test_severity_rank(spark):
    names = ["CRITICAL", "HIGH", "MEDIUM", "LOW", None]
    assert tuple(one(spark, *[tiers.severity_rank(F.lit(n).cast("string")) for n in names])) == (0, 1, 2, 3, 3)


def test_summarize_equals_plain_percentile(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 611).cast("int").alias("v"),
        (F.col("id") % 2 == 0).alias("even"),
    )
    got = summarize(df, ["k"], {"n": F.lit(1)}, value="v", at=(0.25, 0.99), counted=F.col("even"))
    want = df.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile(F.when(F.col("even"), F.col("v")), [0.25, 0.99]).alias("q"),
    )
    assert {r.k: (r.n, r.q) for r in got.collect()} == {r.k: (r.n, r.q) for r in want.collect()}


def test_summarize_without_values_gives_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, v int")
    assert summarize(df, ["k"], {"n": F.lit(1)}, value="v", at=(0.5,)).first().q is None


def test_approximate_percentiles_are_close(spark):
    df = spark.range(100000).select(F.lit("k").alias("k"), F.col("id").cast("int").alias("v"))
    q = summarize(df, ["k"], {}, value="v", at=(0.5, 0.95), approx=True).first().q
    assert q[0] == pytest.approx(50000, abs=50) and q[1] == pytest.approx(95000, abs=50)


def test_cluster_conf_scales_with_the_shuffle():
    from fleetgauge.session import cluster_conf

    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert cluster_conf(1)[first] == "200" and cluster_conf(10000)[first] == "40000"


def test_work_dir_is_under_the_shared_folder(spark, monkeypatch):
    from fleetgauge.session import work_dir

    shared = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and (shared is None or first.startswith(shared.rstrip("/") + "/x-"))


def test_rounding_keeps_missing_and_huge_values(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1e300), (4, 1.005), (5, float("inf")), (6, -2.5)], "i int, x double")
    got = {r.i: r.y for r in df.select("i", numeric.rnd("x", 2).alias("y")).collect()}
    assert got == {1: None, 2: None, 3: 1e300, 4: 1.0, 5: float("inf"), 6: -2.5}
