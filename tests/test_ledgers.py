"""Ledgers: equal to what the events say, added once per batch, no event file opened."""

from __future__ import annotations

import random
from datetime import timedelta

from telemetry import AS_OF, event, events

from fleetgauge.operators.health import health_checks
from fleetgauge.operators.quality import dq_checks
from fleetgauge.plans.arrivals import day_ledger, ledger_checks, recent_arrivals, stamp_ledger
from fleetgauge.plans.metrics import daily_metrics, metric_ledger, metric_rows, refresh_from_ledger
from fleetgauge.plans.operations import ingest_window_status
from fleetgauge.sources.events import as_stored, read_table
from fleetgauge.sources.ledger import FAN
from fleetgauge.sources.sinks import append, append_new, touched_slices
from fleetgauge.streaming.ingest import add_to_ledgers


def batches(n, rng):
    for b in range(n):
        yield b, [
            event(
                b * 20 + i, rng.choice([5, 400, 1500, 4000, -30]), tenant_id=rng.choice(["client_demo", "client_acme"]),
                duration_seconds=rng.choice([None, 10, 70, 900, 4000]), status=rng.choice(["FAILED", "SUCCEEDED"]),
                cost_usd=rng.choice([None, 0.5, 2.25, -1.0]), ingested_at=AS_OF - timedelta(minutes=(n - b) * 17),
            )
            for i in range(12)
        ]


def store(spark, root, rows, name):
    batch = as_stored(events(spark, rows))
    append_new(spark, batch, root, "job_events", "event_id", before=lambda new: add_to_ledgers(spark, root, new, name))
    return batch


def lines(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def test_metrics_from_histograms_equal_those_from_events(spark, tenants, tmp_path):
    root, rng = str(tmp_path), random.Random(8)
    for b, rows in batches(FAN + 2, rng):
        batch = store(spark, root, rows, f"b{b}")
        refresh_from_ledger(spark, root, tenants, touched_slices(batch), AS_OF)
    want = daily_metrics(read_table(spark, root, "job_events"), tenants, AS_OF)
    assert lines(read_table(spark, root, "daily_metrics").select(want.columns)) == lines(want)
    assert len(metric_ledger(spark, root).parts) == 3  # one fold, two parts since


def test_a_batch_is_counted_once_whatever_crashes(spark, tenants, tmp_path):
    root, rng = str(tmp_path), random.Random(9)
    (_, first), (_, second) = batches(2, rng)
    store(spark, root, first, "one")
    add_to_ledgers(spark, root, as_stored(events(spark, second)), "two")  # the run ended before its rows were written
    append(as_stored(events(spark, second[:5])), root, "job_events")  # or when some were
    from fleetgauge.sources.sinks import key_index

    key_index(spark, root, "job_events", "event_id").begin()
    for _ in range(2):
        batch = store(spark, root, second, "two")
    refresh_from_ledger(spark, root, tenants, touched_slices(batch).unionByName(touched_slices(as_stored(events(spark, first)))), AS_OF)
    want = daily_metrics(read_table(spark, root, "job_events"), tenants, AS_OF)
    assert want.agg({"total_jobs": "sum"}).first()[0] == 24
    assert lines(read_table(spark, root, "daily_metrics").select(want.columns)) == lines(want)


def test_a_table_older_than_its_ledgers(spark, tenants, tmp_path):
    root, rng = str(tmp_path), random.Random(10)
    (_, old), (_, new) = batches(2, rng)
    append_new(spark, as_stored(events(spark, old)), root, "job_events", "event_id")
    store(spark, root, new, "new")
    total = metric_ledger(spark, root)
    got = total.shape.merged(total.read())
    want = metric_rows(read_table(spark, root, "job_events"))
    assert lines(got.select(sorted(got.columns))) == lines(want.select(sorted(want.columns)))


def test_quality_and_staleness_need_no_event_file(spark, tenants, tmp_path):
    root, rng = str(tmp_path), random.Random(11)
    for b, rows in batches(3, rng):
        store(spark, root, rows, f"b{b}")
    ev = read_table(spark, root, "job_events")
    assert day_ledger(spark, root).exists()
    for as_of in (AS_OF, AS_OF - timedelta(minutes=20), AS_OF - timedelta(days=2), AS_OF + timedelta(hours=1)):
        assert lines(ledger_checks(spark, root, ev, as_of)) == lines(dq_checks(ev, as_of)), as_of
        arrivals = stamp_ledger(spark, root).read()
        got = health_checks(ev, tenants, as_of, checks=["pipeline_staleness"], arrivals=arrivals)
        assert lines(got) == lines(health_checks(ev, tenants, as_of, checks=["pipeline_staleness"]))
        assert all("/arrivals/" in f for f in got.select("tenant_id").inputFiles()) and "job_events" not in _plan(got)
        for minutes in (20, 2000):
            got = ingest_window_status(ev, as_of, minutes, recent_arrivals(spark, root, as_of, minutes))
            assert lines(got) == lines(ingest_window_status(ev, as_of, minutes)) and "job_events" not in _plan(got)
    plan = _plan(ledger_checks(spark, root, ev, AS_OF))
    scans = [line for line in plan.split("\n") if "FileScan" in line and "/job_events" in line]
    assert len(scans) == 1 and "PartitionFilters: [isnotnull(event_date" in scans[0]


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()
