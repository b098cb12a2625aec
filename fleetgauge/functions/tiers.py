"""Severity and status ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import HealthLimits
from .numeric import as_col


def severity_rank(c: Column | str) -> Column:
    """CRITICAL 0, HIGH 1, MEDIUM 2, anything else 3."""
    c = as_col(c)
    return (
        F.when(c == "CRITICAL", 0).when(c == "HIGH", 1).when(c == "MEDIUM", 2).otherwise(3)
    ).cast("bigint")


def above(value: Column | str, *steps: tuple[float, str], otherwise: str) -> Column:
    """First label whose limit the value exceeds; NULL takes ``otherwise``."""
    value = as_col(value)
    ladder = F
    for limit, label in steps:
        ladder = ladder.when(value > F.lit(float(limit)), F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


def success_severity(rate: Column | str, limits: HealthLimits = HealthLimits()) -> Column:
    return F.when(as_col(rate) < F.lit(limits.success_1h_high), "HIGH").otherwise("MEDIUM")


def spend_severity(percent: Column | str, limits: HealthLimits = HealthLimits()) -> Column:
    return above(
        percent,
        (limits.budget_critical_pct, "CRITICAL"),
        (limits.budget_high_pct, "HIGH"),
        otherwise="MEDIUM",
    )


# The spend ladder and its two vocabularies.
BUDGET_STEPS = ((80.0, "On track", "ON_TRACK"), (100.0, "At risk", "AT_RISK"))
BUDGET_OVER = ("Over budget", "OVER_BUDGET")


def budget_label(percent: Column | str, code: bool = False) -> Column:
    """On track below 80 %, at risk below 100 %, else over budget."""
    percent, pick, ladder = F.coalesce(as_col(percent), F.lit(0.0)), int(code), F
    for limit, *names in BUDGET_STEPS:
        ladder = ladder.when(percent < F.lit(limit), F.lit(names[pick]))
    return ladder.otherwise(F.lit(BUDGET_OVER[pick]))
