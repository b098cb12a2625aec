"""The key index: exact answers, and what a lookup opens."""

from __future__ import annotations

import random

import pytest

from fleetgauge.sources.key_index import FAN, KeyIndex


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "event_id string")


def found(index, spark, keys):
    known = index.known(frame(spark, keys))
    return set() if known is None else {r[0] for r in known.collect()}


def size(index, folder):
    return sum(
        f.stat().st_size for kind, run, bucket in index.opened for f in (folder / kind / f"run={run}" / f"bucket={bucket}").glob("*.parquet")
    )


def test_answers_are_exact_over_many_runs(spark, tmp_path):
    rng, held = random.Random(1), set()
    names = [f"id-{rng.getrandbits(40):x}" for _ in range(900)]
    for i in range(FAN + 3):
        batch = rng.sample(names, 110)
        index = KeyIndex(spark, str(tmp_path), "event_id", bucket_keys=50)
        assert found(index, spark, batch) == held & set(batch)
        index.add(frame(spark, sorted(set(batch) - held)))
        held |= set(batch)
    index = KeyIndex(spark, str(tmp_path), "event_id", bucket_keys=50)
    assert {r[0] for r in index.keys().collect()} == held
    levels = [r["level"] for r in index.runs]
    assert len(levels) <= 2 * FAN and max(levels) == 1 and max(r["bits"] for r in index.runs) > 0


def test_old_runs_stay_closed_for_growing_ids(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "event_id")
    for i in range(5):
        batch = [f"{i * 100 + k:08d}" for k in range(100)]
        assert found(index, spark, batch) == set() and index.opened == []
        index.add(frame(spark, batch))
    assert found(index, spark, ["00000150", "00000499", "5"]) == {"00000150", "00000499"}


@pytest.mark.parametrize("bucket_keys", [40])
def test_bytes_read_do_not_grow_with_the_table(spark, tmp_path, bucket_keys):
    """Random ids: a batch opens a bucket of words for each of its keys at most, and hardly any keys."""
    rng, index, read = random.Random(2), KeyIndex(spark, str(tmp_path), "event_id", bucket_keys), []
    for size_of_run in (2000, 8000, 32000):
        index.add(frame(spark, [f"{rng.getrandbits(64):016x}" for _ in range(size_of_run)]))
        assert found(index, spark, [f"{rng.getrandbits(64):016x}" for _ in range(5)]) == set()
        mine = [o for o in index.opened if o[1] == index.runs[-1]["name"]]
        read.append(len(mine))
        assert len([o for o in mine if o[0] == "words"]) <= 5 and len([o for o in mine if o[0] == "keys"]) <= 1
    assert len(index.runs[-1]["buckets"]) > 500


def test_interrupted_and_empty(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "event_id")
    assert index.known(frame(spark, ["a"])) is None and index.keys() is None
    index.begin()
    assert KeyIndex(spark, str(tmp_path), "event_id").interrupted()
    index.add(frame(spark, []))
    assert not index.interrupted() and index.runs == []
    index.add(frame(spark, [None, "b"]))
    assert index.keys().count() == 1 and index.known(frame(spark, [None])) is None


def test_replaced_runs_are_deleted(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "event_id")
    for i in range(FAN + 2):
        index.add(frame(spark, [f"k{i}"]))
    live = {r["name"] for r in index.runs}
    assert len(live) == 3 and index.keys().count() == FAN + 2
    on_disk = {p.name[4:] for p in (tmp_path / "keys").iterdir()}
    assert live <= on_disk and len(on_disk) == len(live)
