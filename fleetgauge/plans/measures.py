"""Measures shared by the datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.numeric import as_col, from_units, hit, ratio, real, rnd, units


def counts() -> dict[str, Column]:
    """Additive job counts: all, succeeded, failed."""
    return {
        "jobs_n": F.lit(1).cast("bigint"),
        "ok_n": hit(F.col("status") == "SUCCEEDED"),
        "failed_n": hit(F.col("status") == "FAILED"),
    }


def amounts(*names: str) -> dict[str, Column]:
    """Additive units of money or hours columns, named ``<column>_u``."""
    return {f"{n}_u": units(n) for n in names}


def known(name: str) -> dict[str, Column]:
    """Additive count of rows where the column is known, named ``<column>_n``."""
    return {f"{name}_n": hit(real(name).isNotNull())}


def total(name: str, digits: int) -> Column:
    """Rounded total of a column added up by :func:`amounts`."""
    return rnd(from_units(f"{name}_u"), digits)


def mean(name: str, digits: int) -> Column:
    """Rounded mean over the known values of a column."""
    return rnd(ratio(from_units(f"{name}_u"), f"{name}_n"), digits)


def zero(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))
