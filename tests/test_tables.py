from __future__ import annotations

import json
import os
from datetime import timedelta

import pytest
from telemetry import AS_OF, event, events
from pyspark.sql import functions as F

from fleetgauge.operators.incidents import as_stored_incidents, escalations, inline_incidents
from fleetgauge.plans.metrics import daily_metrics, refresh_daily_metrics
from fleetgauge.schemas import DAILY_METRICS, DIGESTS, INCIDENTS, JOB_EVENTS, STORED, create_tables
from fleetgauge.sources.dimensions import read_tenant_settings, read_tenants, with_budget
from fleetgauge.sources.events import as_stored, query, read_table, scan_events
from fleetgauge.sources.sinks import (
    append,
    append_new,
    compact,
    drop_slices,
    export_csv,
    key_index,
    overwrite_slices,
    pinned,
    to_payload,
    touched_slices,
)


def test_declared_shapes():
    assert [len(s) for s in (JOB_EVENTS, DAILY_METRICS, INCIDENTS, DIGESTS)] == [23, 14, 13, 9]
    assert not JOB_EVENTS["event_id"].nullable and JOB_EVENTS["gpu_type"].nullable


def test_insert_twice_is_insert_once(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(i, minutes_ago=600 * i) for i in range(1, 5)] + [event(5, started_at=None), event(1, 600)]
    batch = as_stored(events(spark, rows))
    append_new(spark, batch, root, "job_events", "event_id")
    append_new(spark, batch, root, "job_events", "event_id")
    more = as_stored(events(spark, [event(1, 600), event(9)]))
    append_new(spark, more, root, "job_events", "event_id")
    stored = read_table(spark, root, "job_events")
    assert stored.count() == 6 and stored.select("event_id").distinct().count() == 6
    assert sorted(stored.columns) == sorted(STORED["job_events"].names)


def test_reused_id_on_another_day_is_stored_once(spark, tmp_path):
    root = str(tmp_path)
    for minutes in (10, 5000, 9000):
        append_new(spark, as_stored(events(spark, [event(1, minutes), event(minutes)])), root, "job_events", "event_id")
    assert sorted(r.event_id for r in read_table(spark, root, "job_events").collect()) == ["e1", "e10", "e5000", "e9000"]
    assert key_index(spark, root, "job_events", "event_id").keys().count() == 4


def test_crash_before_the_keys_is_healed(spark, tmp_path):
    root = str(tmp_path)
    batch = as_stored(events(spark, [event(i, 600 * i) for i in range(5)]))
    append_new(spark, batch, root, "job_events", "event_id")
    more = as_stored(events(spark, [event(i, 600 * i) for i in range(3, 9)]))
    key_index(spark, root, "job_events", "event_id").begin()
    append(more.filter("event_id in ('e5', 'e6')"), root, "job_events")  # written, but the run ended before the keys
    for _ in range(2):
        append_new(spark, more, root, "job_events", "event_id")
        assert sorted(r.event_id for r in read_table(spark, root, "job_events").collect()) == [f"e{i}" for i in range(9)]
        assert not key_index(spark, root, "job_events", "event_id").interrupted()
    assert key_index(spark, root, "job_events", "event_id").keys().count() == 9


def test_table_older_than_its_index(spark, tmp_path):
    root = str(tmp_path)
    append(as_stored(events(spark, [event(i, 600 * i) for i in range(5)])), root, "job_events")
    append_new(spark, as_stored(events(spark, [event(i, 10) for i in range(3, 7)])), root, "job_events", "event_id")
    assert read_table(spark, root, "job_events").count() == 7


def test_compaction_keeps_rows_and_bounds_files(spark, tmp_path):
    root = str(tmp_path)
    for i in range(6):
        append_new(spark, as_stored(events(spark, [event(i, 10), event(100 + i, 3000)])), root, "job_events", "event_id")
    before = sorted(map(str, read_table(spark, root, "job_events").collect()))
    compact(spark, root, "job_events", (AS_OF - timedelta(minutes=10)).date())
    assert sorted(map(str, read_table(spark, root, "job_events").collect())) == before
    files = lambda day: len(list((tmp_path / "job_events" / f"event_date={day}").glob("*/part-*.parquet")))
    assert files("2024-01-30") == 1 and files("2024-01-28") == 6


def test_anti_join_reads_only_touched_days(spark, tmp_path):
    from fleetgauge.sources.sinks import touched_days

    root = str(tmp_path)
    append_new(spark, as_stored(events(spark, [event(i, 1500 * i) for i in range(8)])), root, "job_events", "event_id")
    batch = as_stored(events(spark, [event(3, 1500 * 3)]))
    target = read_table(spark, root, "job_events").filter(touched_days(batch, "event_date"))
    assert target.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_slices_are_replaced_and_others_kept(spark, tenants, tmp_path):
    root = str(tmp_path)
    ev = as_stored(events(spark, [event(1, 10), event(2, 2000), event(3, 10, tenant_id="client_acme")]))
    append_new(spark, ev, root, "job_events", "event_id")
    refresh_daily_metrics(spark, root, tenants, touched_slices(ev), AS_OF)
    assert read_table(spark, root, "daily_metrics").count() == 3
    late = as_stored(events(spark, [event(4, 2000, status="FAILED")]))  # an earlier day
    append_new(spark, late, root, "job_events", "event_id")
    refresh_daily_metrics(spark, root, tenants, touched_slices(late), AS_OF)
    got = read_table(spark, root, "daily_metrics")
    want = daily_metrics(read_table(spark, root, "job_events"), tenants, AS_OF)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.agg(F.sum("total_jobs"), F.sum("failed_jobs")).first()[:] == (4, 1)


def test_refresh_broadcasts_the_slices(spark, tenants, tmp_path):
    ev = as_stored(events(spark, [event(1, 10), event(2, 2000)]))
    listed = pinned(touched_slices(ev))
    plan = daily_metrics(ev, tenants, AS_OF, slices=listed)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert listed.count() == 2


def test_slice_without_events_is_removed(spark, tenants, tmp_path):
    root = str(tmp_path)
    ev = as_stored(events(spark, [event(1, 10), event(2, 2000)]))
    append_new(spark, ev, root, "job_events", "event_id")
    refresh_daily_metrics(spark, root, tenants, touched_slices(ev), AS_OF)
    gone = touched_slices(ev.filter("event_id = 'e2'"))
    assert drop_slices(spark, gone, root, "job_events") == 1
    refresh_daily_metrics(spark, root, tenants, touched_slices(ev), AS_OF)
    assert [str(r.metric_date) for r in read_table(spark, root, "daily_metrics").collect()] == ["2024-01-30"]


def test_slices_without_a_name_touch_nothing(spark, tenants, tmp_path):
    root = str(tmp_path)
    ev = as_stored(events(spark, [event(1, 10)]))
    append_new(spark, ev, root, "job_events", "event_id")
    unnamed = touched_slices(ev).withColumn("tenant_id", F.lit(None).cast("string"))
    assert drop_slices(spark, unnamed, root, "job_events") == 0
    assert read_table(spark, root, "job_events").count() == 1


def test_overwrite_with_nothing_changes_nothing(spark, tenants, tmp_path):
    root = str(tmp_path)
    ev = as_stored(events(spark, [event(1)]))
    overwrite_slices(daily_metrics(ev, tenants, AS_OF), root, "daily_metrics")
    overwrite_slices(daily_metrics(ev.limit(0), tenants, AS_OF), root, "daily_metrics")
    assert read_table(spark, root, "daily_metrics").count() == 1


def test_a_table_of_plain_partitions_is_taken_over(spark, tenants, tmp_path):
    root = str(tmp_path)
    old = daily_metrics(as_stored(events(spark, [event(1), event(2, 2000)])), tenants, AS_OF)
    old.write.partitionBy("metric_date", "tenant_id").parquet(f"{root}/daily_metrics")
    new = daily_metrics(as_stored(events(spark, [event(3, status="FAILED"), event(4)])), tenants, AS_OF)
    overwrite_slices(new, root, "daily_metrics")
    got = read_table(spark, root, "daily_metrics").orderBy("metric_date").select("total_jobs", "failed_jobs").collect()
    assert [r[:] for r in got] == [(1, 0), (2, 1)]


def test_append_adds_rows(spark, tmp_path):
    row = spark.createDataFrame(
        [("d", "t", AS_OF.date(), "DAILY", "text", 1, 2.0, "ON_TRACK", AS_OF)], DIGESTS
    )
    append(row, str(tmp_path), "digests")
    append(row, str(tmp_path), "digests")
    assert read_table(spark, str(tmp_path), "digests").count() == 2


def test_csv_has_a_header_and_no_index(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame([("2024-01-30", 1.5)], "date string, total_cost_usd double")
    export_csv(rows.coalesce(1), path)
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    assert open(f"{path}/{part}").read().splitlines() == ["date,total_cost_usd", "2024-01-30,1.5"]


def test_payload_is_keyed_by_tenant(spark, tmp_path):
    payload = to_payload(events(spark, [event(1)]).select("tenant_id", "event_id", "gpu_type"))
    row = payload.first()
    assert row.key == "client_demo"
    assert json.loads(row.value) == {"tenant_id": "client_demo", "event_id": "e1", "gpu_type": None}
    payload.select("value").write.text(str(tmp_path / "topic"))
    assert spark.read.text(str(tmp_path / "topic")).first().value == row.value


def test_tables_have_defaults(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS fg_test LOCATION '" + str(tmp_path / "db") + "'")
    spark.sql("USE fg_test")
    try:
        create_tables(spark, str(tmp_path / "tables"))
        assert {t.name for t in spark.catalog.listTables("fg_test")} >= set(STORED)
        spark.sql(
            "INSERT INTO fg_test.job_events (event_id, job_id, job_name, job_type, tenant_id, project_id, region,"
            " status, machine_type, event_date) VALUES ('e', 'j', 'n', 'TRAINING', 'client_demo', 'p', 'r',"
            " 'FAILED', 'm', DATE '2024-01-01')"
        )
        row = spark.table("fg_test.job_events").first()
        assert (row.gpu_count, row.replica_count, row.cost_usd, row.gpu_type) == (0, 1, 0.0, None)
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE fg_test CASCADE")


def test_tenants_from_files(spark, tenants, tmp_path):
    tenants.write.json(str(tmp_path / "json"))
    assert sorted(read_tenants(spark, str(tmp_path / "json")).collect()) == sorted(tenants.collect())
    tenants.write.option("header", True).csv(str(tmp_path / "csv"))
    assert read_tenants(spark, str(tmp_path / "csv"), "csv").count() == 3
    (tmp_path / "one.yml").write_text(
        "tenant_id: t1\nbudget_threshold_weekly: 700.50\ngpu_policy: open   # unrestricted\n"
        "alert_email: a@b.example\nsla_p95_hours: 2.0\nnotify_on_overrun: true\n"
    )
    row = read_tenant_settings(spark, str(tmp_path / "*.yml")).first()
    assert (row.tenant_id, row.budget_weekly, row.gpu_policy, row.sla_p95_hours) == ("t1", 700.5, "open", 2.0)
    assert row.notify_on_overrun is True and row.region is None
    (tmp_path / "two.yml").write_text(
        "# settings\n\n\ntenant_id: \"t#2\"  # quoted\r\n  # indented\nregion: 'a: b'\nproject_id: p#1\ngpu_policy:\n"
        "alert_email: x # y\nalert_email: last@b.example\n"
    )
    row = read_tenant_settings(spark, str(tmp_path / "two.yml")).first()
    assert (row.tenant_id, row.region, row.project_id, row.gpu_policy, row.alert_email) == ("t#2", "a: b", "p#1", None, "last@b.example")


def test_unknown_tenant_gets_the_default_budget(spark, tenants):
    df = spark.createDataFrame([("nobody",), ("client_demo",)], "tenant_id string")
    got = {r.tenant_id: r.budget_weekly for r in with_budget(df, tenants).collect()}
    assert got == {"nobody": 5000.0, "client_demo": 2500.0}


def test_scan_filters(spark):
    ev = events(spark, [event(1, 10), event(2, 3000), event(3, 10, tenant_id="client_acme")])
    assert [r.event_id for r in scan_events(ev, since="2024-01-30", tenant="client_demo").collect()] == ["e1"]
    assert scan_events(ev, upto="2024-01-30").count() == 1 and scan_events(ev).count() == 3


def test_recent_incidents_read_recent_partitions(spark, tenants, tmp_path):
    root = str(tmp_path)
    ev = events(spark, [event(i, minutes_ago=30, status="FAILED") for i in range(3)])
    for days in (0, 1, 20):
        at = AS_OF - timedelta(days=days, minutes=5)
        found = inline_incidents(ev.withColumn("event_id", F.concat("event_id", F.lit(f"-{days}"))), tenants, as_of=at)
        append_new(spark, as_stored_incidents(found), root, "incidents", "incident_id", unique=True)
    stored = read_table(spark, root, "incidents")
    assert stored.count() == 9
    recent = escalations(stored.withColumn("severity", F.lit("CRITICAL")), AS_OF)
    assert recent.count() == 3
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "detected_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_adhoc_query_raises_errors(spark):
    ev = events(spark, [event(1)])
    df = query(spark, "SELECT count(*) AS n FROM ev WHERE tenant_id = :t", {"ev": ev}, t="client_demo")
    assert df.first().n == 1
    with pytest.raises(Exception, match="nowhere"):
        query(spark, "SELECT * FROM nowhere")
