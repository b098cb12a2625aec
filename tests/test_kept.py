from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from telemetry import AS_OF, event, events

from fleetgauge.plans.metrics import daily_metrics
from fleetgauge.sources.key_index import KeyIndex
from fleetgauge.sources.ledger import Ledger
from fleetgauge.sources.manifests import Manifest
from fleetgauge.streaming.kept import kept_totals, make_totals_writer, start_kept_totals, totals_ledger

ROWS = [
    event(i, minutes_ago=500 * i, status="FAILED" if i % 4 == 0 else "SUCCEEDED", cost_usd=float(i),
          tenant_id="client_demo" if i % 3 else "client_acme")
    for i in range(1, 31)
]
NO_START = event("no-start", started_at=None, completed_at=None)
NO_ID = event("no-id", event_id=None)
# The newest rows come first, so that all of the second batch is late; copies within and across the batches.
BATCHES = [ROWS[:12] + ROWS[:3] + [NO_START], ROWS[20:] + ROWS[5:12] + [NO_ID, NO_ID], ROWS[10:22] + ROWS[15:18]]


def wanted(spark):
    none = spark.createDataFrame([], "tenant_id string, budget_weekly double")
    return daily_metrics(events(spark, ROWS), none, AS_OF)


def same(spark, root):
    got = kept_totals(spark, root)
    return sorted(map(str, got.collect())) == sorted(map(str, wanted(spark).select(got.columns).collect()))


def late_ids(spark, root):
    return sorted(r.event_id for r in spark.read.parquet(f"{root}/late").select("event_id").collect())


def test_no_row_vanishes_over_restarts(spark, tmp_path):
    root, feed = str(tmp_path / "tables"), tmp_path / "feed"
    schema = events(spark, ROWS).schema
    for k, rows in enumerate(BATCHES):  # each run starts anew from the checkpoint
        events(spark, rows).coalesce(1).write.parquet(str(feed / str(k)))
        stream = spark.readStream.schema(schema).parquet(f"{feed}/*")
        start_kept_totals(stream, root, str(tmp_path / "cp"), delay=timedelta(days=1)).awaitTermination()
    assert same(spark, root)
    newest = {r[0] for r in events(spark, BATCHES[0]).filter("started_at is not null").select(F.max("started_at")).collect()}.pop()
    old = {"e%d" % i for i in range(13, 31) if AS_OF - timedelta(minutes=500 * i) < newest - timedelta(days=1)}
    assert late_ids(spark, root) == sorted(old)
    assert spark.read.parquet(f"{root}/unplaced").count() == 3
    # a stream that forgot its offsets counts nothing twice
    start_kept_totals(spark.readStream.schema(schema).parquet(f"{feed}/*"), root, str(tmp_path / "cp2")).awaitTermination()
    assert same(spark, root) and late_ids(spark, root) == sorted(old)


@pytest.mark.parametrize("step", ["sums", "mark", "keys"])
def test_crash_between_two_steps(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "tables")
    write = make_totals_writer(root, timedelta(days=1))
    write(events(spark, BATCHES[0]), 0)
    target, name = {"sums": (Ledger, "add"), "keys": (KeyIndex, "add"), "mark": (Manifest, "commit")}[step]

    def failing(self, *args, **kwargs):
        if step != "mark" or self.folder.endswith("/marks"):
            raise RuntimeError("executor lost")
        return real(self, *args, **kwargs)

    real = getattr(target, name)
    monkeypatch.setattr(target, name, failing)
    with pytest.raises(RuntimeError, match="executor lost"):
        write(events(spark, BATCHES[1]), 1)
    monkeypatch.setattr(target, name, real)
    write(events(spark, BATCHES[1]), 1)
    write(events(spark, BATCHES[1]), 1)  # and once more, as if only the stream's own commit had been lost
    write(events(spark, BATCHES[2]), 2)
    assert same(spark, root)
    assert len(late_ids(spark, root)) == len(set(late_ids(spark, root))) == 18
    assert totals_ledger(spark, root).read().agg(F.sum("total_jobs")).first()[0] == len(ROWS)


def test_empty_batches(spark, tmp_path):
    root = str(tmp_path / "tables")
    write = make_totals_writer(root)
    write(events(spark, []), 0)
    write(events(spark, [NO_START, NO_ID]), 1)
    assert kept_totals(spark, root).collect() == []
    assert spark.read.parquet(f"{root}/unplaced").count() == 2
