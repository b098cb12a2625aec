from __future__ import annotations

import json
from datetime import timedelta

import pytest
from telemetry import AS_OF, by, event, events

from fleetgauge.operators import quality
from fleetgauge.operators.quality import (
    EVENT_SUITE,
    QualityError,
    assert_quality,
    dq_checks,
    expect,
    load_suite,
    quarantine,
)


def fresh(number, **changes):
    return event(number, ingested_at=AS_OF - timedelta(minutes=1), **changes)


def test_clean_rows_pass_every_check(spark):
    checks = dq_checks(events(spark, [fresh(1), fresh(2)]), AS_OF)
    assert all(r.passed for r in checks.collect())
    assert_quality(checks)


def test_empty_table_fails_freshness_only(spark):
    checks = by(dq_checks(events(spark, []), AS_OF).collect(), "check_name")
    assert [n for n, r in checks.items() if not r.passed] == ["recent_rows"]
    assert all(r.value == 0 for r in checks.values())


def test_each_defect_is_counted_and_stops_the_run(spark):
    rows = [
        fresh(None, cost_usd=-1.0),
        fresh(2, duration_seconds=-1),
        fresh(3, started_at=AS_OF + timedelta(seconds=1)),
    ]
    rows[0] = (None, *rows[0][1:])
    checks = dq_checks(events(spark, rows), AS_OF)
    values = {r.check_name: r.value for r in checks.collect()}
    assert values == {
        "null_event_id": 1, "negative_cost": 1, "future_start": 1, "recent_rows": 3, "negative_duration": 1
    }
    with pytest.raises(QualityError, match="negative_cost"):
        assert_quality(checks)


def test_expectations_count_unexpected_rows(spark):
    rows = [fresh(1), fresh(1), fresh(1), fresh(2, status="LOST"), fresh(3, cost_usd=10000.0),
            fresh(4, cost_usd=10000.01), fresh(5, job_type=None, duration_seconds=172801)]
    got = {(r.expectation, r.column_name): (r.unexpected_count, r.success) for r in expect(events(spark, rows)).collect()}
    assert len(got) == len(EVENT_SUITE) == 10
    assert got["expect_column_values_to_be_unique", "event_id"] == (2, False)
    assert got["expect_column_values_to_be_in_set", "status"] == (1, False)
    assert got["expect_column_values_to_be_between", "cost_usd"] == (1, False)
    assert got["expect_column_values_to_be_between", "duration_seconds"] == (1, False)
    assert got["expect_column_values_to_be_in_set", "job_type"] == (0, True)  # NULL is not judged
    assert got["expect_column_to_exist", "event_id"] == (0, True)


def test_absent_column_fails_its_expectations(spark):
    got = by(expect(events(spark, [fresh(1)]).drop("gpu_hours")).collect(), "position")
    assert (got[8].unexpected_count, got[8].success) == (None, False)
    assert got[1].success


def test_suite_file_round_trip(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps({"expectation_suite_name": "x", "expectations": list(EVENT_SUITE)}))
    ev = events(spark, [fresh(1), fresh(1)])
    assert expect(ev, load_suite(str(path))).collect() == expect(ev).collect()


def test_unknown_expectation_is_refused(spark):
    with pytest.raises(ValueError, match="unknown expectation"):
        expect(events(spark, []), [{"expectation_type": "expect_magic", "kwargs": {"column": "status"}}])


def test_quarantine_splits_without_loss(spark):
    rows = [fresh(1), fresh(2, status=None), fresh(3, status="LOST", cost_usd=-1.0),
            fresh(4, started_at=None, completed_at=None), fresh(5, started_at=AS_OF + timedelta(days=1))]
    ev = events(spark, rows)
    clean, bad = quarantine(ev, AS_OF)
    assert sorted(r.event_id for r in clean.collect()) == ["e1", "e2"]
    reasons = {r.event_id: r.reasons for r in bad.collect()}
    assert reasons == {
        "e3": ["status not in set", "cost_usd out of range"],
        "e4": ["started_at null"],
        "e5": ["started_at in the future"],
    }


def test_counts_of_the_write_equal_the_scan(spark, tmp_path):
    rows = [event(i, status="LOST" if i % 3 == 0 else "FAILED", cost_usd=-1.0 if i % 4 == 0 else 2.0) for i in range(20)]
    ev = events(spark, rows + [event(1), event(2, tenant_id=None)]).repartition(3)
    frame, seen = quality.watched(ev)
    frame.write.parquet(str(tmp_path / "out"))
    got = quality.expectation_rows(spark, seen.get, ev.columns, {"event_id": 2})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.expect(ev).collect()))
    narrow = quality.expectation_rows(spark, {"n": 1}, ["status"], {})
    assert [r.unexpected_count for r in narrow.orderBy("position").collect()][:5] == [None, None, None, None, 0]
