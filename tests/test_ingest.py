from __future__ import annotations

import json
from datetime import datetime

from telemetry import AS_OF, by, event, events
from pyspark.sql import functions as F

from fleetgauge.operators.costs import with_costs
from fleetgauge.schemas import WIRE_EVENT
from fleetgauge.sources.events import apply_defaults, as_stored, decode_events
from fleetgauge.sources.sinks import first_per_key, new_rows, touched_days


def wire(**fields):
    return json.dumps({"event_id": "e1", "tenant_id": "client_demo", **fields})


def decode(spark, *lines):
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    return decode_events(raw)


def test_wire_schema_has_24_nullable_fields():
    assert len(WIRE_EVENT) == 24 and all(f.nullable for f in WIRE_EVENT)


def test_decode_keeps_events_and_rejects_the_rest(spark):
    good, bad = decode(
        spark,
        wire(started_at="2024-01-30T10:00:00.123456", duration_seconds=5, is_anomaly=True),
        wire(event_id=None),
        '{"event_id": "half',
        "not json",
        "",
    )
    row = good.first()
    assert good.count() == 1
    assert row.started_at == datetime(2024, 1, 30, 10, 0, 0, 123456) and row.is_anomaly is True
    reasons = [r.reason for r in bad.collect()]
    assert sorted(reasons).count("missing event_id") == 1 and len(reasons) == 4


def test_bad_time_becomes_null(spark):
    good, _ = decode(spark, wire(started_at="yesterday", completed_at=None))
    assert tuple(good.select("started_at", "completed_at").first()) == (None, None)


def test_decode_parses_each_line_once(spark):
    good, _ = decode(spark, wire())
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_defaults_fill_only_what_is_missing(spark):
    gaps = dict(gpu_count=None, replica_count=None, gpu_hours=None, cpu_hours=None, cost_usd=None)
    ev = events(spark, [event(1, ingested_at=None, **gaps), event(2, gpu_count=4, cost_usd=2.5)])
    rows = by(apply_defaults(ev, AS_OF).collect(), "event_id")
    r = rows["e1"]
    assert (r.gpu_count, r.replica_count, r.gpu_hours, r.cpu_hours, r.cost_usd) == (0, 1, 0.0, 0.0, 0.0)
    assert r.ingested_at == AS_OF
    assert (rows["e2"].gpu_count, rows["e2"].cost_usd) == (4, 2.5)


def test_stored_shape_adds_date_companions(spark):
    row = as_stored(events(spark, [event(1, started_at=None), event(2)])).orderBy("event_id").collect()
    assert row[0].event_date is None and str(row[1].event_date) == "2024-01-30"


def test_first_per_key_is_deterministic(spark):
    rows = [event(1, cost_usd=float(i)) for i in range(50)]
    forward = first_per_key(events(spark, rows), "event_id").first()
    backward = first_per_key(events(spark, rows[::-1]).repartition(4), "event_id").first()
    assert forward == backward


def test_first_per_key_honours_order(spark):
    ev = events(spark, [event(1, minutes_ago=5), event(1, minutes_ago=50)])
    kept = first_per_key(ev, "event_id", [F.col("started_at").asc()]).collect()
    assert len(kept) == 1 and kept[0].started_at.hour == 23 and kept[0].started_at.minute == 10


def test_copies_collapse_before_the_shuffle(spark):
    ev = events(spark, [event(1)]).crossJoin(spark.range(100)).drop("id")
    plan = first_per_key(ev, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_new_rows_drops_known_keys(spark):
    target = as_stored(events(spark, [event(1), event(2, started_at=None)]))
    batch = as_stored(events(spark, [event(1), event(2, started_at=None), event(3), event(3)]))
    assert [r.event_id for r in new_rows(batch, target, "event_id").collect()] == ["e3"]
    assert new_rows(batch, None, "event_id").count() == 3
    plan = new_rows(batch, target, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # one per side


def test_touched_days_lists_every_day(spark):
    batch = as_stored(events(spark, [event(1), event(2, minutes_ago=60 * 24 * 3), event(3, started_at=None)]))
    listed = batch.filter(touched_days(batch, "event_date"))
    assert listed.count() == 3
    only_null = batch.filter(F.col("event_date").isNull())
    assert batch.filter(touched_days(only_null, "event_date")).count() == 1


def test_costs_follow_the_price_list(spark, rates):
    ev = events(
        spark,
        [
            event(1, machine_type="a2-highgpu-4g", duration_seconds=3600),
            event(2, machine_type="n1-highmem-16", duration_seconds=1800),
            event(3, machine_type="unknown", duration_seconds=7200),
            event(4, duration_seconds=None),
        ],
    )
    rows = by(with_costs(ev, rates).collect(), "event_id")
    assert (rows["e1"].gpu_type, rows["e1"].gpu_hours, rows["e1"].cost_usd) == ("NVIDIA_TESLA_A100", 4.0, 11.72)
    assert rows["e2"].cost_usd == round(0.5 * 0.35 + 0.5 * 0.64, 6)
    assert (rows["e3"].gpu_count, rows["e3"].cost_usd) == (0, 0.3)
    assert rows["e4"].cost_usd is None
