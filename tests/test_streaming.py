from __future__ import annotations

import json
from datetime import timedelta

import pytest
from telemetry import AS_OF, event, events
from pyspark.sql import functions as F

from fleetgauge.operators.incidents import inline_incidents
from fleetgauge.plans.metrics import daily_metrics
from fleetgauge.schemas import JOB_EVENTS
from fleetgauge.sources.events import parse_lines, read_events_stream, read_lines_stream, read_table
from fleetgauge.streaming import ingest
from fleetgauge.streaming.daily import dedup_stream, latest_totals, start_daily_totals, stream_daily_totals
from fleetgauge.streaming.ingest import make_batch_writer, start_ingest


def line(row):
    fields = dict(zip(JOB_EVENTS.names, row))
    for c in ("started_at", "completed_at", "ingested_at"):
        fields[c] = fields[c].isoformat() if fields[c] else None
    fields.pop("ingested_at")
    return json.dumps({**fields, "is_anomaly": False, "emitted_at": AS_OF.isoformat()})


ROWS = [
    event(i, minutes_ago=200 * i, status="FAILED" if i % 4 == 0 else "SUCCEEDED",
          duration_seconds=9500 if i % 5 == 0 else 500, cost_usd=float(i),
          tenant_id="client_demo" if i % 3 else "client_acme")
    for i in range(1, 31)
]


@pytest.fixture
def topic(tmp_path):
    """Three files, one per micro-batch, with repeats inside and across, late rows and garbage."""
    folder = tmp_path / "topic"
    folder.mkdir()
    batches = [ROWS[20:] + ROWS[25:], ROWS[5:25], ROWS[:8] + ROWS[28:]]
    garbage = [["not json"], [line((None, *ROWS[0][1:])), "{"], []]
    for i, (rows, extra) in enumerate(zip(batches, garbage)):
        (folder / f"part-{i}.txt").write_text("\n".join([*map(line, rows), *extra]) + "\n")
    return str(folder)


def arrival(batch_id):
    return AS_OF + timedelta(minutes=batch_id)


def drain(spark, topic, root, tenants, checkpoint, **options):
    writer = make_batch_writer(root, tenants, arrival, **options)
    lines = read_lines_stream(spark, topic, files_per_trigger=1)
    start_ingest(lines, writer, checkpoint, every=None).awaitTermination()


def state(spark, root):
    stored = read_table(spark, root, "job_events")
    metrics = read_table(spark, root, "daily_metrics").drop("computed_at")
    incidents = read_table(spark, root, "incidents").drop("detected_at", "detected_date")
    rejected = spark.read.parquet(f"{root}/rejected")
    return [sorted(map(str, d.collect())) for d in (stored.drop("ingested_at", "ingest_date"), metrics, incidents, rejected.drop("batch", "batch_id"))]


def test_stream_equals_batch(spark, tenants, tmp_path, topic):
    root = str(tmp_path / "tables")
    drain(spark, topic, root, tenants, str(tmp_path / "cp"))
    stored = read_table(spark, root, "job_events")
    assert stored.count() == 30 == stored.select("event_id").distinct().count()
    want = daily_metrics(events(spark, ROWS), tenants, AS_OF).drop("computed_at")
    got = read_table(spark, root, "daily_metrics").select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    ids = {r.incident_id for r in read_table(spark, root, "incidents").collect()}
    assert ids == {r.incident_id for r in inline_incidents(events(spark, ROWS), tenants).collect()}
    assert read_table(spark, root, "incidents").count() == len(ids)
    assert spark.read.parquet(f"{root}/rejected").count() == 3


def test_replay_changes_nothing(spark, tenants, tmp_path, topic):
    root = str(tmp_path / "tables")
    drain(spark, topic, root, tenants, str(tmp_path / "cp1"))
    before = state(spark, root)
    drain(spark, topic, root, tenants, str(tmp_path / "cp2"))  # all batches again
    assert state(spark, root) == before


def test_crash_between_events_and_incidents_is_healed(spark, tenants, tmp_path, topic, monkeypatch):
    from fleetgauge.streaming import ingest

    root, real = str(tmp_path / "tables"), ingest.append_new

    def failing(spark_, batch, root_, table, *args, **kwargs):
        if table == "incidents":
            raise RuntimeError("executor lost")
        real(spark_, batch, root_, table, *args, **kwargs)

    monkeypatch.setattr(ingest, "append_new", failing)
    with pytest.raises(Exception, match="executor lost"):
        drain(spark, topic, root, tenants, str(tmp_path / "cp"))
    monkeypatch.setattr(ingest, "append_new", real)
    drain(spark, topic, root, tenants, str(tmp_path / "cp"))
    want = {r.incident_id for r in inline_incidents(events(spark, ROWS), tenants).collect()}
    assert {r.incident_id for r in read_table(spark, root, "incidents").collect()} == want
    assert read_table(spark, root, "job_events").count() == 30


def test_lines_are_gathered_once(spark, tenants, tmp_path, monkeypatch):
    """A batch's lines pass once: no frame is kept but the events that come of them, and what is set aside keeps its number."""
    frame = type(spark.range(1))
    kept, real = [], frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *level: kept.append(self.columns) or real(self, *level))
    row = {**dict(zip(JOB_EVENTS.names, event(1), strict=True)), "ingested_at": None}
    lines = [json.dumps({**row, "cost_usd": float(i)}, default=str) for i in range(5)] + ["not json"] * 3 + [""] * 4
    root = str(tmp_path / "tables")
    ingest.make_batch_writer(root, tenants, lambda i: AS_OF)(spark.createDataFrame([(x,) for x in lines], "value string"), 0)
    assert len(kept) == 1 and read_table(spark, root, "job_events").count() == 1
    rejected = {(r.value, r["count"]) for r in spark.read.parquet(f"{root}/rejected").groupBy("value").count().collect()}
    assert rejected == {("not json", 3), ("", 4)}
    counts = {r.expectation: r.unexpected_count for r in spark.read.parquet(f"{root}/expectations").filter("column_name = 'event_id'").collect()}
    assert counts["expect_column_values_to_be_unique"] == 4


def test_a_rejected_line_of_any_number(spark):
    rows = spark.createDataFrame([(None, "x", 140000), (None, "y", 65536), ("e", None, 9)], "event_id string, value string, _copies long")
    got = {(r.value, r["count"]) for r in ingest._rejected(rows).groupBy("value").count().collect()}
    assert got == {("x", 140000), ("y", 65536)}


def test_files_of_the_stream_grow_in_number(spark, monkeypatch):
    """However many lines there are, they come in two micro-batches, and no task writes or reads more than its part."""
    import __spark_entry__ as entry

    seen, real = [], entry.read_lines_stream
    monkeypatch.setattr(entry, "PART", 200, raising=False)
    monkeypatch.setattr(entry, "read_lines_stream", lambda s, path, files_per_trigger: seen.append((path, files_per_trigger)) or real(s, path, files_per_trigger))
    rows = entry._stream_ingest(spark, "/root/testdata/sf0.001")
    path, taken = seen[0]
    lines = [r["count"] for r in spark.read.text(path).groupBy(F.input_file_name()).count().collect()]
    assert len(lines) == 2 * taken >= sum(lines) / 300 and max(lines) <= 300
    assert rows.count() == rows.select("event_id").distinct().count() > 900


def test_one_tenant_only(spark, tenants, tmp_path, topic):
    root = str(tmp_path / "tables")
    drain(spark, topic, root, tenants, str(tmp_path / "cp"), tenant="client_acme")
    assert {r.tenant_id for r in read_table(spark, root, "job_events").collect()} == {"client_acme"}


@pytest.mark.parametrize("lanes", [1, 256])
def test_daily_totals_over_several_batches(spark, tmp_path, topic, lanes):
    parsed = parse_lines(read_lines_stream(spark, topic, files_per_trigger=1)).filter("event_id IS NOT NULL")
    totals = stream_daily_totals(dedup_stream(parsed, delay="30 days", lanes=lanes))
    out = str(tmp_path / "daily")
    start_daily_totals(totals, out, str(tmp_path / "cp")).awaitTermination()
    got = latest_totals(spark.read.parquet(out))
    want = daily_metrics(events(spark, ROWS), spark.createDataFrame([], "tenant_id string, budget_weekly double"), AS_OF)
    assert spark.read.parquet(out).count() > got.count()  # older versions are kept aside
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_topic_source_needs_the_connector(spark):
    try:
        stream = read_events_stream(spark, "localhost:9092", "topic")
    except Exception as e:  # the connector jar is not part of this installation
        assert "kafka" in str(e).lower()
    else:
        assert stream.isStreaming and stream.columns == ["value"]


def test_lines_are_streamed(spark, topic):
    stream = read_lines_stream(spark, topic)
    assert stream.isStreaming and stream.columns == ["value"]
    assert spark.read.text(topic).filter(F.col("value") == "not json").count() == 1
