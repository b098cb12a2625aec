"""Text for titles, descriptions and digests; every part tolerates NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def shown(c: Column | str) -> Column:
    """A value as text, ``n/a`` when missing, so one NULL never blanks a sentence."""
    return F.coalesce(as_col(c).cast("string"), F.lit("n/a"))


def fixed(c: Column | str, digits: int) -> Column:
    """A number with a fixed count of decimals, no separators."""
    c = as_col(c).cast("double")
    return F.when(c.isNull(), F.lit("n/a")).otherwise(F.format_string(f"%.{digits}f", c))


def usd(c: Column | str, digits: int = 2) -> Column:
    """``$1,234.50``."""
    return F.coalesce(
        F.concat(F.lit("$"), F.format_number(as_col(c).cast("double"), digits)), F.lit("n/a")
    )


def clipped(c: Column | str, length: int, mark: str = "") -> Column:
    """At most ``length`` characters, with ``mark`` appended when something was cut."""
    c = as_col(c)
    if not mark:
        return F.substring(c, 1, length)
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit(mark))).otherwise(c)


def say(*parts: Column | str) -> Column:
    """Concatenate; plain strings are literal text, columns are values."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else shown(p) for p in parts])


def stable_id(*parts: Column) -> Column:
    """A key that is the same on every run for the same subject."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]), 256)
