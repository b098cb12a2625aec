"""The shared baseline gives what each detector finds by itself, in two scans."""

from __future__ import annotations

import random
import statistics

import pytest
from telemetry import AS_OF, event, events

from __spark_entry__ import own_queries
from fleetgauge.operators import baseline, detect
from fleetgauge.settings import DetectorLimits


def crowd(rng, n):
    rows = []
    for i in range(n):
        tenant = rng.choice(["client_demo", "client_demo", "client_acme", None])
        rare = rng.random() < 0.02
        rows.append(
            event(
                i, rng.choice([3, 30, 59.9, 60, 300, 1439, 1440, 3000, 9000, 10081]), tenant_id=tenant, gpu_count=rng.choice([0, 1, 4, None]),
                job_type=rng.choice(["TRAINING", "BATCH_PREDICTION", None]), machine_type=rng.choice(["a", "b"]),
                status=rng.choice(["FAILED", "SUCCEEDED", "SUCCEEDED"]),
                duration_seconds=None if rng.random() < 0.05 else (90000 if rare else rng.randint(1, 900)),
                cost_usd=rng.choice([None, float("nan")]) if rng.random() < 0.05 else (900.0 if rare else round(rng.random() * 3, 6)),
            )
        )
    return rows


def alone(ev, hours, limits):
    parts = [
        detect.cost_spikes(ev, AS_OF, hours, limits), detect.duration_outliers(ev, AS_OF, hours, limits),
        detect.failure_bursts(ev, AS_OF, limits), detect.gpu_waste_pattern(ev, AS_OF, hours, limits),
    ]
    return sorted(tuple(r) for p in parts for r in p.select(*detect.ANOMALY_COLUMNS).collect())


@pytest.mark.parametrize("hours", [24, 6, 240])
def test_equals_the_detectors_by_themselves(spark, hours):
    ev = events(spark, crowd(random.Random(hours), 1500)).repartition(3).cache()
    limits = DetectorLimits(burst_points=-5.0, waste_flag_pct=5.0, top_spikes=3, top_outliers=2)
    got = sorted(tuple(r) for r in detect.all_anomalies(ev, AS_OF, hours, limits).collect())
    assert got == alone(ev, hours, limits)
    assert {r[3] for r in got} == {"COST_SPIKE", "DURATION_OUTLIER", "FAILURE_BURST", "GPU_WASTE_PATTERN"}
    ev.unpersist()


def test_deviation_is_exact_where_costs_hardly_differ(spark):
    costs = [9000.0 + i * 1e-6 for i in range(50)]
    ev = events(spark, [event(i, 60 * 30, cost_usd=c, duration_seconds=10 + i % 3) for i, c in enumerate(costs)])
    row = baseline.measured(ev, AS_OF).filter("level = 'group'").first()
    assert row.std_cost == pytest.approx(statistics.stdev(range(50)) * 1e-6, rel=1e-12)
    one = events(spark, [event(1)])
    assert baseline.measured(one, AS_OF).filter("level = 'group'").first().std_cost is None


def test_nothing_and_only_old_events(spark):
    assert detect.all_anomalies(events(spark, []), AS_OF).collect() == []
    old = events(spark, [event(i, 60 * 24 * 9 + i) for i in range(30)])
    assert detect.all_anomalies(old, AS_OF).collect() == []


@pytest.mark.parametrize("name, scans", [("all_anomalies", 2), ("health_run_summary", 3)])
def test_event_scans(spark, name, scans):
    plan = own_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == scans
    assert "WindowGroupLimit" in plan
