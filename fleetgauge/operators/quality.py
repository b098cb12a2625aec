"""Data quality: run checks, declarative expectations, quarantine."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import Moment, between, stamp, trailing
from ..functions.numeric import hit
from ..schemas import BIGINT, BOOLEAN, JOB_EVENTS, STRING
from ..settings import JOB_TYPES, STATUSES
from ..sources.dimensions import literal_table


class QualityError(ValueError):
    """Raised by :func:`assert_quality`; names the failed checks."""


CHECK_NAMES = ("null_event_id", "negative_cost", "future_start", "recent_rows", "negative_duration")


def dq_checks(ev: DataFrame, as_of: Moment, fresh_minutes: float = 30) -> DataFrame:
    """Five checks as (check_name, value, passed) from one scan."""
    bad = {
        "null_event_id": F.col("event_id").isNull(),
        "negative_cost": F.col("cost_usd") < 0,
        "future_start": F.col("started_at") > stamp(as_of),
        "recent_rows": between("ingested_at", **trailing(as_of, minutes=fresh_minutes)),
        "negative_duration": F.col("duration_seconds") < 0,
    }
    return as_check_rows(ev.agg(*[F.coalesce(F.sum(hit(c)), F.lit(0)).alias(n) for n, c in bad.items()]))


def as_check_rows(counted: DataFrame) -> DataFrame:
    """(check_name, value, passed) from one row with a count per check."""
    rows = [
        F.struct(
            F.lit(n).alias("check_name"),
            F.col(n).alias("value"),
            (F.col(n) > 0 if n == "recent_rows" else F.col(n) == 0).alias("passed"),
        )
        for n in CHECK_NAMES
    ]
    return counted.select(F.explode(F.array(*rows)).alias("c")).select("c.*")


def assert_quality(checks: DataFrame) -> None:
    """Stop the run when a check failed. Brings back the names of failed checks only."""
    failed = [r[0] for r in checks.filter(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise QualityError(f"failed quality checks: {sorted(failed)}")


def _expectation(kind: str, column: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": {"column": column, **kwargs}}


# The expectation suite over job events.
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
EVENT_SUITE = (
    _expectation(EXISTS, "event_id"),
    _expectation(NOT_NULL, "event_id"),
    _expectation(UNIQUE, "event_id"),
    _expectation(NOT_NULL, "tenant_id"),
    _expectation(IN_SET, "status", value_set=STATUSES),
    _expectation(BETWEEN, "cost_usd", min_value=0, max_value=10000),
    _expectation(BETWEEN, "duration_seconds", min_value=0, max_value=172800),
    _expectation(BETWEEN, "gpu_hours", min_value=0, max_value=1000),
    _expectation(NOT_NULL, "started_at"),
    _expectation(IN_SET, "job_type", value_set=JOB_TYPES),
)


# What a stored event has to keep: the suite and every required column of the table.
STORED_SUITE = EVENT_SUITE + tuple(
    _expectation(NOT_NULL, f.name)
    for f in JOB_EVENTS
    if not f.nullable and f.name not in ("event_id", "tenant_id")
)


def load_suite(path: str) -> list[dict]:
    """Expectations of a JSON suite file."""
    return json.loads(Path(path).read_text())["expectations"]


def _violation(exp: Mapping) -> Column | None:
    """Predicate that is true for a row breaking a row-level expectation."""
    kind, args = exp["expectation_type"], exp["kwargs"]
    c = F.col(args["column"])
    if kind == NOT_NULL:
        return c.isNull()
    if kind == IN_SET:
        return c.isNotNull() & ~c.isin(*args["value_set"])
    if kind == BETWEEN:
        broken = F.lit(False)
        if args.get("min_value") is not None:
            broken = broken | (c < args["min_value"])
        if args.get("max_value") is not None:
            broken = broken | (c > args["max_value"])
        return c.isNotNull() & broken
    if kind in (EXISTS, UNIQUE):
        return None
    raise ValueError(f"unknown expectation {kind}")


def expect(df: DataFrame, suite: Sequence[Mapping] = EVENT_SUITE) -> DataFrame:
    """One row per expectation: how many rows break it, and whether it holds.

    All row-level expectations share one scan. Uniqueness counts the surplus
    rows per value (NULLs aside); it is a separate scan of that one column,
    combined on the map side, so the wide scan needs no shuffle by key. An
    expectation on an absent column fails with an unknown count.
    """
    totals: list[Column] = []
    uniques: list[tuple[int, str]] = []
    fixed: list[Column] = []

    def result(i: int, exp: Mapping, count: Column) -> Column:
        return F.struct(
            F.lit(i + 1).cast("bigint").alias("position"),
            F.lit(exp["expectation_type"]).alias("expectation"),
            F.lit(exp["kwargs"]["column"]).alias("column_name"),
            count.cast("bigint").alias("unexpected_count"),
            F.coalesce(count == 0, F.lit(False)).alias("success"),
        )

    for i, exp in enumerate(suite):
        column, kind = exp["kwargs"]["column"], exp["expectation_type"]
        violation = _violation(exp)
        if column not in df.columns:
            fixed.append(result(i, exp, F.lit(None).cast("bigint")))
        elif kind == EXISTS:
            fixed.append(result(i, exp, F.lit(0)))
        elif kind == UNIQUE:
            uniques.append((i, column))
        else:
            totals.append(F.coalesce(F.sum(hit(violation)), F.lit(0)).alias(f"v{i}"))
    scanned = df.agg(F.count(F.lit(1)).alias("n"), *totals)
    rows = fixed + [result(i, suite[i], F.col(c)) for i, c in _positions(scanned)]
    parts = [scanned.select(F.explode(F.array(*rows)).alias("r"))] if rows else []
    for i, column in uniques:
        copies = df.filter(F.col(column).isNotNull()).groupBy(column).count()
        surplus = copies.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("surplus"))
        parts.append(surplus.select(result(i, suite[i], F.col("surplus")).alias("r")))
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined.select("r.*")


_RESULT = T.StructType(
    [
        T.StructField("position", BIGINT), T.StructField("expectation", STRING), T.StructField("column_name", STRING),
        T.StructField("unexpected_count", BIGINT), T.StructField("success", BOOLEAN),
    ]
)


def watched(df: DataFrame, suite: Sequence[Mapping] = EVENT_SUITE) -> tuple[DataFrame, Observation]:
    """``df`` to be written, and counts of what breaks the suite that come with the write.

    Write the frame as it is: counted in the tasks that write, a row counts once however often a
    task or what is above it was repeated. Uniqueness is no property of a row and not counted.
    """
    seen = Observation()
    tests = {i: _violation(exp) for i, exp in enumerate(suite) if exp["kwargs"]["column"] in df.columns}
    counts = [F.coalesce(F.sum(hit(v)), F.lit(0)).alias(f"v{i}") for i, v in tests.items() if v is not None]
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *counts), seen


def expectation_rows(
    spark: SparkSession, counted: Mapping[str, int], columns: Sequence[str],
    surplus: Mapping[str, int], suite: Sequence[Mapping] = EVENT_SUITE,
) -> DataFrame:
    """The rows of :func:`expect` from watched counts; ``surplus``: repeats per unique column."""
    rows = []
    for i, exp in enumerate(suite):
        column, kind = exp["kwargs"]["column"], exp["expectation_type"]
        n = None
        if column in columns:
            n = surplus.get(column) if kind == UNIQUE else 0 if kind == EXISTS else counted.get(f"v{i}", 0)
        rows.append((i + 1, kind, column, n, n == 0))
    return literal_table(spark, rows, _RESULT)


def _positions(scanned: DataFrame) -> list[tuple[int, str]]:
    return [(int(c[1:]), c) for c in scanned.columns if c.startswith("v")]


def _row_tests(
    df: DataFrame, as_of: Moment, suite: Sequence[Mapping]
) -> list[tuple[str, Column]]:
    """(reason, predicate) of every row-level check the columns of ``df`` allow."""
    label = {NOT_NULL: "null", IN_SET: "not in set", BETWEEN: "out of range"}
    columns = df.columns
    tests = []
    for exp in suite:
        column, violation = exp["kwargs"]["column"], _violation(exp)
        if violation is not None and column in columns:
            tests.append((f"{column} {label[exp['expectation_type']]}", violation))
    if "started_at" in columns:
        tests.append(("started_at in the future", F.col("started_at") > stamp(as_of)))
    return tests


def broken(df: DataFrame, as_of: Moment, suite: Sequence[Mapping] = EVENT_SUITE) -> Column:
    """Whether a row breaks any of the row-level checks; never NULL."""
    tests = _row_tests(df, as_of, suite)
    return reduce(Column.__or__, [F.coalesce(test, F.lit(False)) for _, test in tests], F.lit(False))


def quarantine(
    df: DataFrame, as_of: Moment, suite: Sequence[Mapping] = EVENT_SUITE
) -> tuple[DataFrame, DataFrame]:
    """``(clean, bad)``: rows that pass, and rows that do not with an array of ``reasons``.

    Which side a row falls on is a plain predicate, so it reaches the scan;
    the reasons are spelled out for the bad rows only. Repeated keys are not
    a property of one row: the insert by key takes care of them.
    """
    fails = broken(df, as_of, suite)
    spelled = F.array_compact(F.array(*[F.when(test, F.lit(text)) for text, test in _row_tests(df, as_of, suite)]))
    return df.filter(~fails), df.filter(fails).withColumn("reasons", spelled)
