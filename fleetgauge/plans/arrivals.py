"""What arrived when: two ledgers that answer the periodic jobs without opening event files.

``arrivals`` counts events and failures per tenant and arrival stamp (a batch has one stamp), ``arrival_days`` counts events and bad
values per day of arrival and day of start. Both are added to by the batch writer.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import Moment, clip, moment, stamp, trailing
from ..functions.numeric import hit
from ..operators.quality import as_check_rows
from ..schemas import BIGINT, DATE, NTZ, STRING
from ..sources.ledger import Ledger, Shape

_STAMPS = Shape(
    T.StructType(
        [
            T.StructField("tenant_id", STRING), T.StructField("ingested_at", NTZ), T.StructField("ingest_date", DATE),
            T.StructField("events", BIGINT), T.StructField("failures", BIGINT),
        ]
    ),
    ("tenant_id", "ingested_at", "ingest_date"), "ingest_date",
)
_DAYS = Shape(
    T.StructType(
        [T.StructField("ingest_date", DATE), T.StructField("event_date", DATE)]
        + [T.StructField(c, BIGINT) for c in ("events", "null_event_id", "negative_cost", "negative_duration")]
    ),
    ("ingest_date", "event_date"), "ingest_date",
)


def stamp_ledger(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/arrivals", _STAMPS)


def day_ledger(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/arrival_days", _DAYS)


def stamp_rows(ev: DataFrame) -> DataFrame:
    """What stored events add to ``arrivals``."""
    return ev.groupBy(*_STAMPS.keys).agg(F.count(F.lit(1)).alias("events"), F.sum(hit(F.col("status") == "FAILED")).alias("failures"))


def recent_arrivals(spark: SparkSession, root: str, as_of: Moment, minutes: float) -> DataFrame:
    """Counts of the arrivals of the last minutes; only the parts and row groups of their days are read."""
    now = moment(as_of)
    rows = stamp_ledger(spark, root).read(since=(now - timedelta(minutes=minutes)).date(), until=now.date())
    return clip(rows, "ingested_at", **trailing(as_of, minutes=minutes))


def day_rows(ev: DataFrame) -> DataFrame:
    """What stored events add to ``arrival_days``."""
    return ev.groupBy(*_DAYS.keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(hit(F.col("event_id").isNull())).alias("null_event_id"),
        F.sum(hit(F.col("cost_usd") < 0)).alias("negative_cost"),
        F.sum(hit(F.col("duration_seconds") < 0)).alias("negative_duration"),
    )


def ledger_checks(spark: SparkSession, root: str, ev: DataFrame, as_of: Moment, fresh_minutes: float = 30) -> DataFrame:
    """The rows of ``dq_checks`` over the stored events, from the ledgers.

    Only starts on the very day of ``as_of`` have to be looked at one by one; days after it count as a whole. All
    other values are sums over days.
    """
    days = day_ledger(spark, root).read()
    now = moment(as_of)
    today = F.lit(now.date())
    totals = days.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("null_event_id", "negative_cost", "negative_duration")],
        F.coalesce(F.sum(F.when(F.col("event_date") > today, F.col("events"))), F.lit(0)).alias("future_start"),
    )
    later = ev.filter((F.col("event_date") == today) & (F.col("started_at") > stamp(as_of)))
    recent = recent_arrivals(spark, root, as_of, fresh_minutes)
    zero = F.lit(0).cast("bigint")
    names = totals.columns
    parts = totals.withColumn("recent_rows", zero)
    for name, rows in (("future_start", later.agg(F.count(F.lit(1)).alias("n"))), ("recent_rows", recent.agg(F.sum("events").alias("n")))):
        filled = {c: F.coalesce("n", zero) if c == name else zero for c in (*names, "recent_rows")}
        parts = parts.unionByName(rows.select(*[v.alias(c) for c, v in filled.items()]))
    return as_check_rows(parts.agg(*[F.sum(c).alias(c) for c in parts.columns]))
