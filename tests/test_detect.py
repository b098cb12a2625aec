from __future__ import annotations

import random
from datetime import timedelta

import pytest
from telemetry import AS_OF, by, event, events

from fleetgauge.operators import detect
from fleetgauge.operators.incidents import anomalies_to_incidents, inline_incidents, open_incidents


def quiet(n, minutes_ago=60 * 48, **changes):
    return [event(f"q{i}", minutes_ago, cost_usd=1.0 + (i % 2) * 0.1, **changes) for i in range(n)]


def test_cost_spike_is_found_with_its_numbers(spark):
    ev = events(spark, quiet(60) + [event("spike", cost_usd=50.0)])
    rows = detect.cost_spikes(ev, AS_OF).collect()
    assert [r.event_id for r in rows] == ["spike"]
    spike = rows[0]
    assert spike.severity == "CRITICAL" and spike.metric_value == 50.0 and spike.z_score > 5
    assert spike.title.startswith("fraud-detection cost $50.00, ")


@pytest.mark.parametrize("others, found", [(8, 0), (30, 1)])
def test_cost_spike_needs_ten_samples(spark, others, found):
    ev = events(spark, quiet(others) + [event("spike", cost_usd=500.0)])
    assert detect.cost_spikes(ev, AS_OF).count() == found
    assert detect.cost_baseline(ev, AS_OF).count() == found


def test_constant_cost_and_single_rows_raise_nothing(spark):
    ev = events(spark, [event(i) for i in range(12)] + [event("x", machine_type="a2-highgpu-1g", cost_usd=9.0)])
    assert detect.cost_spikes(ev, AS_OF).count() == 0


def test_old_spike_is_outside_the_window(spark):
    ev = events(spark, quiet(60) + [event("spike", 60 * 24 + 1, cost_usd=50.0)])
    assert detect.cost_spikes(ev, AS_OF).count() == 0
    assert detect.cost_spikes(ev, AS_OF, window_hours=48).count() == 1


def test_top_spikes_per_tenant_rank_across_groups(spark):
    rows = []
    for machine in ("n1-standard-4", "n1-standard-8"):
        rows += [event(f"{machine}{i}", 3000, machine_type=machine, cost_usd=1.0 + i % 3) for i in range(2000)]
        rows += [event(f"{machine}s{i}", machine_type=machine, cost_usd=60.0 + i) for i in range(15)]
    found = detect.cost_spikes(events(spark, rows), AS_OF).collect()
    assert len(found) == 20
    z = [r.z_score for r in found]
    everything = detect.cost_spikes(
        events(spark, rows), AS_OF, limits=detect.DetectorLimits(top_spikes=1000)
    ).collect()
    assert len(everything) == 30
    assert sorted(z, reverse=True) == sorted((r.z_score for r in everything), reverse=True)[:20]


def test_duration_fence_and_outliers(spark):
    rows = [event(i, 3000, duration_seconds=100 + i) for i in range(101)]
    rows += [event(f"long{i}", duration_seconds=5000 + i) for i in range(12)]
    rows += [event("none", duration_seconds=None)]
    ev = events(spark, rows)
    fence = detect.duration_fence(ev, AS_OF).first()
    assert fence.fence == fence.q3 + 2.5 * (fence.q3 - fence.q1)
    found = detect.duration_outliers(ev, AS_OF).collect()
    assert sorted(r.event_id for r in found) == sorted(f"long{i}" for i in range(2, 12))
    assert all(r.severity == "MEDIUM" and r.threshold_value == round(fence.fence, 1) for r in found)


def test_duration_outliers_without_data(spark):
    assert detect.duration_outliers(events(spark, []), AS_OF).count() == 0


@pytest.mark.parametrize("bad, severity", [(2, None), (3, "HIGH"), (4, "HIGH"), (5, "CRITICAL")])
def test_failure_burst_edges(spark, bad, severity):
    rows = [event(f"b{i}", 600) for i in range(10)]
    rows += [event(f"r{i}", 10, status="FAILED" if i < bad else "SUCCEEDED") for i in range(10)]
    rows += [event("edge", 60, status="FAILED")]  # in neither window
    found = detect.failure_bursts(events(spark, rows), AS_OF).collect()
    assert [r.severity for r in found] == ([severity] if severity else [])
    if found:
        assert (found[0].metric_value, found[0].threshold_value) == (10.0 * bad, 20.0)


def test_failure_burst_needs_both_sides(spark):
    ev = events(spark, [event(i, 10, status="FAILED") for i in range(5)])
    assert detect.failure_bursts(ev, AS_OF).count() == 0


@pytest.mark.parametrize("n, short, found", [(10, 1, 0), (10, 2, 1), (9, 9, 0)])
def test_gpu_waste_edges(spark, n, short, found):
    rows = [event(i, gpu_count=1, cost_usd=3.0, duration_seconds=299 if i < short else 300) for i in range(n)]
    got = detect.gpu_waste_pattern(events(spark, rows), AS_OF).collect()
    assert len(got) == found
    if found:
        assert (got[0].metric_value, got[0].threshold_value, got[0].avg_wasted_cost) == (20.0, 20.0, 3.0)


def test_all_anomalies_have_the_common_shape_and_stable_ids(spark):
    rows = quiet(60) + [event("spike", cost_usd=50.0, duration_seconds=90000)]
    rows += [event(f"f{i}", status="FAILED") for i in range(3)]
    rows += [event(f"g{i}", gpu_count=1, duration_seconds=10) for i in range(10)]
    found = detect.all_anomalies(events(spark, rows), AS_OF)
    assert tuple(found.columns) == detect.ANOMALY_COLUMNS
    kinds = {r.anomaly_type for r in found.collect()}
    assert kinds == {"COST_SPIKE", "DURATION_OUTLIER", "FAILURE_BURST", "GPU_WASTE_PATTERN"}
    first = {r.anomaly_id for r in found.collect()}
    again = {r.anomaly_id for r in detect.all_anomalies(events(spark, rows[::-1]), AS_OF).collect()}
    assert first == again and len(first) == found.count()
    assert anomalies_to_incidents(found, AS_OF).filter("status = 'OPEN'").count() == len(first)


def brute_force(rows, days=7, factor=2.5):
    """(event_id -> (jobs, mean)) by scanning all pairs."""
    found = {}
    for r in rows:
        if r.started_at is None or r.duration_seconds is None:
            continue
        at = int((r.started_at.replace(microsecond=0) - AS_OF).total_seconds())
        frame = [
            o.duration_seconds for o in rows
            if o.started_at is not None and o.duration_seconds is not None
            and (o.tenant_id, o.job_type) == (r.tenant_id, r.job_type)
            and at - days * 86400 <= int((o.started_at.replace(microsecond=0) - AS_OF).total_seconds()) <= at - 1
        ]
        if frame and r.duration_seconds > factor * (sum(frame) / len(frame)):
            found[r.event_id] = (len(frame), round(sum(frame) / len(frame), 6))
    return found


def test_rolling_baseline_equals_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        # Coarse minutes make shared seconds and exact frame edges frequent.
        rows.append(event(i, rng.choice([0, 1, 5]) + 60 * 24 * rng.choice([0, 1, 2, 6, 7, 7, 8, 13, 14]),
                          tenant_id=rng.choice(["client_demo", "client_acme"]),
                          job_type=rng.choice(["TRAINING", "PIPELINE_RUN"]),
                          duration_seconds=rng.choice([None, 10, 20, 400, 1000])))
    rows.append(event("nostart", started_at=None, completed_at=None))
    ev = events(spark, rows)
    got = {r.event_id: (r.baseline_jobs, r.baseline_seconds) for r in detect.latency_spikes_rolling(ev).collect()}
    want = {k: (n, round(m, 2)) for k, (n, m) in brute_force(ev.collect()).items()}
    assert set(got) == set(want) and len(want) > 20
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=0.011)


def test_inline_rules_can_all_hit_one_event(spark, tenants):
    ev = events(
        spark,
        [
            event(1, status="FAILED", duration_seconds=9001, cost_usd=100.0),
            event(2, duration_seconds=9000, cost_usd=round(2500 / 70, 6) - 1e-6),
            event(3, status="FAILED", duration_seconds=None, cost_usd=None),
            event(4, tenant_id="nobody", cost_usd=72.0),  # default budget: 10 % of a day is 71.43
            event(5, tenant_id="nobody", cost_usd=71.0),
        ],
    )
    rows = inline_incidents(ev, tenants).collect()
    got = {(r.event_id, r.incident_type): r for r in rows}
    assert set(got) == {
        ("e1", "JOB_FAILURE"), ("e1", "LATENCY_SPIKE"), ("e1", "COST_OVERRUN"),
        ("e3", "JOB_FAILURE"), ("e4", "COST_OVERRUN"),
    }
    assert got["e1", "COST_OVERRUN"].severity == "HIGH" and got["e4", "COST_OVERRUN"].severity == "MEDIUM"
    assert got["e3", "JOB_FAILURE"].metric_value is None
    assert got["e3", "JOB_FAILURE"].description is not None
    assert got["e1", "COST_OVERRUN"].title == "High-cost job: fraud-detection ($100.00)"
    assert len({r.incident_id for r in rows}) == len(rows)


def test_open_incidents_order_age_and_top(spark):
    rows = [
        ("a", "t", "MEDIUM", "OPEN", AS_OF - timedelta(minutes=1)),
        ("b", "t", "CRITICAL", "OPEN", AS_OF - timedelta(minutes=90)),
        ("c", "t", "CRITICAL", "OPEN", AS_OF - timedelta(minutes=5)),
        ("d", "t", "HIGH", "RESOLVED", AS_OF),
        ("e", "u", "LOW", "OPEN", None),
    ]
    inc = spark.createDataFrame(rows, "incident_id string, tenant_id string, severity string, status string, detected_at timestamp_ntz")
    ranked = open_incidents(inc, AS_OF).collect()
    assert [r.incident_id for r in ranked] == ["c", "b", "a", "e"]
    assert [r.age_minutes for r in ranked] == [5, 90, 1, None]
    assert [r.incident_id for r in open_incidents(inc, AS_OF, top=1).collect()] == ["c", "e"]
    assert [r.incident_id for r in open_incidents(inc, AS_OF, tenant="u").collect()] == ["e"]


def test_shapes_do_not_depend_on_row_order(spark):
    rows = quiet(40) + [event(f"s{i}", cost_usd=40.0 + i) for i in range(3)]
    random.Random(3).shuffle(rows)
    a = by(detect.cost_spikes(events(spark, rows), AS_OF).collect(), "event_id")
    b = by(detect.cost_spikes(events(spark, rows[::-1]).repartition(3), AS_OF).collect(), "event_id")
    assert {k: v.metric_value for k, v in a.items()} == {k: v.metric_value for k, v in b.items()}


@pytest.mark.parametrize("k", [1, 3, 10])
def test_highest_per_equals_a_full_ranking(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice("aaaab"), f"id{i}", rng.choice([None, 1.0, 2.0, float(i % 90)])) for i in range(900)]
    rows += [("few", "f1", None), ("few", "f2", 1.0)]
    df = spark.createDataFrame(rows, "t string, id string, v double").repartition(4)
    got = detect.highest_per(df, ["t"], "v", "id", k)
    from pyspark.sql import functions as F

    want = detect.top_per(df, ["t"], [F.col("v").desc_nulls_last(), F.col("id").asc()], k)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_missing_number_raises_no_alarm(spark):
    rows = [event(i, minutes_ago=10 + i, cost_usd=1.0 + i % 3, status="SUCCEEDED") for i in range(40)]
    rows.append(event(99, minutes_ago=5, cost_usd=float("nan")))
    assert detect.cost_spikes(events(spark, rows), AS_OF).count() == 0
    assert detect.cost_baseline(events(spark, rows), AS_OF).first().std_cost < 1
