"""Daily totals of a stream that lose no row, however late it comes.

A watermark bounds the state of ``streaming.daily`` and drops what is older. Here the state is stored instead:
the key index says which events have been counted, whatever their day, and a ledger holds the sums. A batch reads
its own rows and the index's words for them; nothing is kept in an executor's memory between batches.

Rows that a watermark of ``delay`` would have dropped are counted like the others and also written to ``late``; rows
without an id or a start, which belong to no day, to ``unplaced``. So each row is counted, or is a copy of
a counted one, or lies in ``unplaced``.

A batch's steps are: side tables, sums, mark, keys. The sums bear the name of the batch's content, so a batch that
comes again after a crash between any two steps adds nothing twice. One stream per ``root``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import from_units, hit, rnd, units
from ..schemas import BIGINT, DATE, STRING
from ..sources.key_index import KeyIndex
from ..sources.ledger import Ledger, Shape
from ..sources.manifests import Manifest
from ..sources.sinks import first_per_key
from .daily import KEYS

COUNTS, AMOUNTS = ("total_jobs", "succeeded_jobs", "failed_jobs"), ("gpu_hours", "cpu_hours", "cost_usd")
_SHAPE = Shape(
    T.StructType(
        [T.StructField("metric_date", DATE), T.StructField("tenant_id", STRING), T.StructField("job_type", STRING)]
        + [T.StructField(c, BIGINT) for c in (*COUNTS, *(f"{c}_u" for c in AMOUNTS))]
    ),
    KEYS, "metric_date",
)


def totals_ledger(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/daily_totals", _SHAPE)


def _rows(events: DataFrame) -> DataFrame:
    """What each event adds to the sums."""
    status = F.col("status")
    counts = (F.lit(1), hit(status == "SUCCEEDED"), hit(status == "FAILED"))
    return events.select(
        F.to_date("started_at").alias("metric_date"), "tenant_id", "job_type",
        *[n.cast("bigint").alias(c) for c, n in zip(COUNTS, counts)],
        *[units(c).alias(f"{c}_u") for c in AMOUNTS],
    )


def make_totals_writer(
    root: str, delay: timedelta = timedelta(hours=1), key: str = "event_id"
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function. ``delay`` only says which rows count as late, by the newest start of earlier batches."""

    def aside(rows: DataFrame, table: str, batch_id: int) -> None:
        # An empty frame writes nothing: a replay whose keys are known by now leaves the first run's rows.
        if not rows.isEmpty():
            rows.write.mode("overwrite").parquet(f"{root}/{table}/batch={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placeable = F.col(key).isNotNull() & F.col("started_at").isNotNull()
        # Blocks lost with an executor are rebuilt from the source, whose offsets are fixed for the batch.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        first = first_per_key(batch.filter(placeable), key).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            aside(batch.filter(~placeable), "unplaced", batch_id)
            h = F.xxhash64(key)
            seen = first.agg(
                F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.bit_xor(F.xxhash64(h)).alias("y"),
                F.max("started_at").cast("string").alias("newest"),
            ).first()
            if not seen.n:
                return
            name = f"{seen.n}-{seen.x:x}-{seen.y:x}"
            marks = Manifest(spark, f"{root}/marks")
            version, mark = marks.read()
            again = mark is not None and mark["name"] == name
            before = None if mark is None else mark["before" if again else "after"]
            index = KeyIndex(spark, f"{root}/daily_keys", key)
            known = index.known(first)
            new = first if known is None else first.join(known, key, "left_anti")
            if before is not None:
                limit = F.lit(before).cast(first.schema["started_at"].dataType) - F.lit(delay)
                aside(new.filter(F.col("started_at") < limit), "late", batch_id)
            totals_ledger(spark, root).add(name, _rows(new))
            if not again:
                newest = seen.newest if before is None else max(before, seen.newest)
                marks.commit(version, {"name": name, "before": before, "after": newest})
            index.add(new.select(key))
        finally:
            first.unpersist()
            batch.unpersist()

    return write


def start_kept_totals(
    events: DataFrame, root: str, checkpoint: str, delay: timedelta = timedelta(hours=1), every: str | None = None
) -> StreamingQuery:
    """Start the stream of events; ``every=None`` drains what is available and stops."""
    query = events.writeStream.foreachBatch(make_totals_writer(root, delay)).option("checkpointLocation", checkpoint)
    query = query.trigger(processingTime=every) if every else query.trigger(availableNow=True)
    return query.start()


def kept_totals(spark: SparkSession, root: str) -> DataFrame:
    """The totals of each day, tenant and job type, in rounded units."""
    ledger = totals_ledger(spark, root)
    return _SHAPE.merged(ledger.read()).select(
        *KEYS, *COUNTS, *[rnd(from_units(f"{c}_u"), 4).alias(f"total_{c}") for c in AMOUNTS]
    )
