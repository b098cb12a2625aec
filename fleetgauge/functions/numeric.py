"""Number recipe: every rounding and every money sum goes through here.

Money and hours are added as whole millionths in a BIGINT. That makes a sum
independent of row order and partitioning (a plain double sum is not), keeps
the partial aggregation in generated code, and fails loudly on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1e6
# From here on every double is a whole number, and BIGINT soon ends.
WHOLE = 2.0**53


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def real(c: Column | str) -> Column:
    """A number as double; NaN counts as missing."""
    return F.nanvl(as_col(c).cast("double"), F.lit(None).cast("double"))


def rnd(c: Column | str, digits: int) -> Column:
    """Round half up on the binary value: ``floor(x * 10^d + 0.5) / 10^d``.

    NaN gives NULL; a value too large for whole units has no such digits and stays.
    """
    scale = F.lit(10.0**digits)
    value = real(c)
    return F.when(F.abs(value * scale) >= F.lit(WHOLE), value).otherwise(F.floor(value * scale + F.lit(0.5)) / scale)


def units(c: Column | str) -> Column:
    """An amount in whole millionths; NaN counts as missing."""
    return F.floor(real(c) * F.lit(MILLION) + F.lit(0.5))


def from_units(c: Column | str) -> Column:
    return as_col(c).cast("double") / F.lit(MILLION)


def hit(condition: Column) -> Column:
    """1 where the condition holds, else 0: an additive BIGINT measure."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as double; NULL when there is nothing to divide by."""
    return F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double"))


def pct(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(
        F.lit(100.0) * as_col(part).cast("double"), as_col(whole).cast("double")
    )


def hours(seconds: Column | str, digits: int) -> Column:
    """Seconds from an interpolated percentile, snapped first, as rounded hours."""
    return rnd(rnd(seconds, 2) / F.lit(3600.0), digits)
