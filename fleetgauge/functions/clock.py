"""Explicit clock. Nothing in the package reads the wall clock.

``as_of`` is the moment a result is computed for. Trailing windows are
``(as_of - n, as_of]``; the calendar day is the one that ends at or holds
``as_of``, so an ``as_of`` at midnight closes the day before.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DATE_COMPANION
from .numeric import as_col

Moment = datetime | date | str


def moment(value: Moment) -> datetime:
    """A datetime from a datetime, a date (its midnight) or ISO text."""
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    return value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)


def today(as_of: Moment) -> date:
    return (moment(as_of) - timedelta(microseconds=1)).date()


def day_start(day: date | str) -> datetime:
    day = date.fromisoformat(day) if isinstance(day, str) else day
    return datetime(day.year, day.month, day.day)


def stamp(value: Moment) -> Column:
    """A zone-free timestamp literal, foldable and so fit for pushdown."""
    return F.expr(f"TIMESTAMP_NTZ '{moment(value).isoformat(sep=' ')}'")


def _day_lit(value: datetime) -> Column:
    return F.expr(f"DATE '{value.date().isoformat()}'")


def between(
    column: str,
    after: Moment | None = None,
    since: Moment | None = None,
    until: Moment | None = None,
    before: Moment | None = None,
) -> Column:
    """``after < c``, ``since <= c``, ``c <= until``, ``c < before``; any may be absent."""
    c = F.col(column)
    tests = []
    if after is not None:
        tests.append(c > stamp(after))
    if since is not None:
        tests.append(c >= stamp(since))
    if until is not None:
        tests.append(c <= stamp(until))
    if before is not None:
        tests.append(c < stamp(before))
    result = tests[0]
    for t in tests[1:]:
        result = result & t
    return result


def clip(df: DataFrame, column: str = "started_at", **bounds: Moment | None) -> DataFrame:
    """Filter by :func:`between`, repeating the bounds on the date companion.

    Parquet skips nothing on TIMESTAMP_NTZ, so where the table carries the
    companion DATE column (a partition or a plain column) the same range is
    stated on it too.
    """
    companion = DATE_COMPANION.get(column)
    has_companion = companion in df.columns
    df = df.filter(between(column, **bounds))
    if has_companion:
        lows = [moment(bounds[k]) for k in ("after", "since") if bounds.get(k) is not None]
        highs = [moment(bounds[k]) for k in ("until", "before") if bounds.get(k) is not None]
        if lows:
            df = df.filter(F.col(companion) >= _day_lit(max(lows)))
        if highs:
            df = df.filter(F.col(companion) <= _day_lit(min(highs)))
    return df


def trailing(as_of: Moment, **span: float) -> dict[str, datetime]:
    """Bounds of the window ``(as_of - span, as_of]`` for :func:`clip` / :func:`between`."""
    end = moment(as_of)
    return {"after": end - timedelta(**span), "until": end}


def calendar_day(as_of: Moment, days: int = 1) -> dict[str, datetime]:
    """Half-open bounds of the last ``days`` calendar days, today included."""
    end = day_start(today(as_of)) + timedelta(days=1)
    return {"since": end - timedelta(days=days), "before": end}


# Date parts. All read the zone-free wall clock, so the session zone is irrelevant.


def epoch_seconds(c: Column | str) -> Column:
    c = as_col(c)
    return (
        F.unix_date(F.to_date(c)).cast("bigint") * 86400
        + F.hour(c) * 3600
        + F.minute(c) * 60
        + F.second(c)
    )


def epoch_minutes(c: Column | str) -> Column:
    c = as_col(c)
    return F.unix_date(F.to_date(c)).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed: 00:00:59 to 00:01:01 is 1."""
    return epoch_minutes(end) - epoch_minutes(start)


def week_start(c: Column | str) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(F.to_date(as_col(c)), "week")


def weekday(c: Column | str) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(as_col(c)) - 1).cast("bigint")
