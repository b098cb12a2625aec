"""Slice tables: equal to a dictionary of slices, whatever is replaced, folded or crashed."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from fleetgauge.sources.slices import FAN, SliceTable

SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("who", T.StringType()), T.StructField("v", T.LongType())])
KEYS = ("day", "who")
START = date(2024, 1, 1)


def open_table(spark, root):
    return SliceTable(spark, f"{root}/t", SCHEMA, KEYS)


def replace(spark, root, content):
    """``content``: the values of each slice, none for one that is to go."""
    slices = spark.createDataFrame(list(content), T.StructType(SCHEMA.fields[:2]))
    rows = spark.createDataFrame([(*k, v) for k, values in content.items() for v in values], SCHEMA)
    open_table(spark, root).replace(slices, lambda staged: rows)


def held(spark, root, **days):
    return sorted(map(str, open_table(spark, root).read(**days).collect()))


def rows_of(model):
    return sorted(str(T.Row(day=k[0], who=k[1], v=v)) for k, values in model.items() for v in values)


def test_equals_a_dictionary_over_two_folds(spark, tmp_path):
    rng, model, root = random.Random(3), {}, str(tmp_path)
    for i in range(2 * FAN + 3):
        names = {(START + timedelta(days=rng.randrange(6)), rng.choice(["a", "b", None])) for _ in range(4)}
        content = {k: [rng.randrange(99) for _ in range(rng.randrange(3))] for k in names}
        replace(spark, root, content)
        model |= content
        if i in (0, 3, FAN - 1, FAN, 2 * FAN - 1):
            assert held(spark, root) == rows_of(model), i
    assert held(spark, root) == rows_of(model)
    assert [p["level"] for p in open_table(spark, root).parts] == [1, 1, 0, 0, 0]
    since, until = START + timedelta(days=2), START + timedelta(days=3)
    assert held(spark, root, since=since, until=until) == rows_of({k: v for k, v in model.items() if since <= k[0] <= until})


@pytest.mark.parametrize("step", ["_stage", "_store", "_commit"])
def test_a_crash_changes_nothing_and_leaves_nothing(spark, tmp_path, monkeypatch, step):
    root, one, two = str(tmp_path), (START, "a"), (START, "b")
    replace(spark, root, {one: [1], two: [2]})
    before, real = held(spark, root), getattr(SliceTable, step)

    def crash(self, *args):
        if step != "_commit":
            real(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(SliceTable, step, crash)
    with pytest.raises(RuntimeError):
        replace(spark, root, {one: [5], two: []})
    assert held(spark, root) == before
    monkeypatch.undo()
    replace(spark, root, {one: [5], two: []})
    assert held(spark, root) == rows_of({one: [5]})
    table = open_table(spark, root)
    assert sorted(table.manifest.folders(f"{root}/t/data")) == sorted(p["path"] for p in table.parts)


def test_a_reader_keeps_its_version(spark, tmp_path):
    root, key = str(tmp_path), (START, "a")
    replace(spark, root, {key: [1]})
    reader = open_table(spark, root).read()
    for value in range(2, FAN + 1):  # the last of them folds
        replace(spark, root, {key: [value]})
        if value == FAN - 1:
            assert [r.v for r in reader.collect()] == [1]
    assert held(spark, root) == rows_of({key: [FAN]})
    assert len(open_table(spark, root).parts) == 1


def test_parts_of_other_days_are_not_opened(spark, tmp_path):
    root = str(tmp_path)
    for i in range(3):
        replace(spark, root, {(START + timedelta(days=i), "a"): [i]})
    got = open_table(spark, root).read(since=START + timedelta(days=2))
    assert len({f.split("/data/")[1].split("/")[0] for f in got.inputFiles()}) == 1
    assert [r.v for r in got.collect()] == [2]


def test_no_slices_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    replace(spark, root, {})
    assert not open_table(spark, root).exists()
    replace(spark, root, {(START, "a"): [1]})
    replace(spark, root, {})
    assert held(spark, root) == rows_of({(START, "a"): [1]})
