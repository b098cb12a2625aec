"""Grouped sums together with exact percentiles, safe for hot groups.

``percentile`` over raw rows sends one value map per map task to whichever
task owns the group, so a group with a third of all rows becomes a straggler.
Here rows are first added up per (group, value): the hot group spreads over
all reducers by value. The percentile is then taken over at most one row per
distinct whole second, weighted by how often it occurred.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import hit


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    value: str | None = None,
    at: Sequence[float] = (),
    counted: Column | None = None,
    maxima: Mapping[str, Column] | None = None,
    minima: Mapping[str, Column] | None = None,
    approx: bool = False,
    accuracy: int = 10000,
) -> DataFrame:
    """Group by ``keys``; add up ``sums``; percentiles ``at`` of ``value`` as ``q``.

    ``counted`` restricts which rows enter the percentiles, not the sums.
    ``q`` is an array in the order of ``at``, NULL for a group without values.
    ``approx`` replaces the exact percentile by a sketch: one shuffle, small
    buffers whatever the number of distinct values.
    """
    maxima, minima = dict(maxima or {}), dict(minima or {})
    if value is None or approx:
        aggs = [F.sum(c).alias(n) for n, c in sums.items()]
        aggs += [F.max(c).alias(n) for n, c in maxima.items()]
        aggs += [F.min(c).alias(n) for n, c in minima.items()]
        if value is not None:
            seen = F.col(value) if counted is None else F.when(counted, F.col(value))
            aggs.append(F.percentile_approx(seen, list(at), accuracy).cast("array<double>").alias("q"))
        return df.groupBy(*keys).agg(*aggs)

    rows = histogram(df, keys, sums, value, counted, maxima, minima)
    return of_histogram(rows, keys, list(sums), at, list(maxima), list(minima))


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column],
    value: str,
    counted: Column | None = None,
    maxima: Mapping[str, Column] | None = None,
    minima: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key and value: ``_weight`` and the measures. Such rows can be added up with others."""
    weight = F.count(F.lit(1)) if counted is None else F.sum(hit(counted))
    return df.groupBy(*keys, F.col(value).alias("_value")).agg(
        weight.alias("_weight"),
        *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.max(c).alias(n) for n, c in (maxima or {}).items()],
        *[F.min(c).alias(n) for n, c in (minima or {}).items()],
    )


def of_histogram(
    rows: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    at: Sequence[float],
    maxima: Sequence[str] = (),
    minima: Sequence[str] = (),
) -> DataFrame:
    """Totals and exact percentiles ``q`` per key from histogram rows, several to a value or one."""
    return rows.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.max(n).alias(n) for n in maxima],
        *[F.min(n).alias(n) for n in minima],
        F.percentile("_value", [float(p) for p in at], F.col("_weight")).alias("q"),
    )
