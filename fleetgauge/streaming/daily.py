"""Daily totals kept by the stream itself: deduplicated, watermarked, tumbling days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import from_units, hit, rnd, units
from ..operators.detect import top_per

KEYS = ("metric_date", "tenant_id", "job_type")


def dedup_stream(
    events: DataFrame, key: str = "event_id", delay: str = "1 hour", lanes: int = 256
) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other.

    The watermark bounds the state. Rows without a start time cannot be placed
    and are left to the table side; later repeats are caught there by key.
    A stream cannot combine before its shuffle, so all copies of one key would
    meet in one task. They are first dropped per (key, input lane), which
    spreads them over ``lanes`` tasks and leaves at most one per lane for the
    final step. ``lanes=1`` saves that step's state where copies are rare.
    """
    placed = events.filter(F.col("started_at").isNotNull()).withWatermark("started_at", delay)
    if lanes > 1:
        lane = F.pmod(F.spark_partition_id(), F.lit(lanes))
        placed = placed.withColumn("_lane", lane).dropDuplicatesWithinWatermark([key, "_lane"])
        placed = placed.drop("_lane")
    return placed.dropDuplicatesWithinWatermark([key])


def stream_daily_totals(events: DataFrame) -> DataFrame:
    """Counts, hours and cost per day, tenant and job type over a watermarked stream."""
    day = F.window("started_at", "1 day")
    totals = events.groupBy(day, "tenant_id", "job_type").agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.sum(hit(F.col("status") == "SUCCEEDED")).alias("succeeded_jobs"),
        F.sum(hit(F.col("status") == "FAILED")).alias("failed_jobs"),
        *[F.sum(units(c)).alias(f"{c}_u") for c in ("gpu_hours", "cpu_hours", "cost_usd")],
    )
    return totals.select(
        F.to_date("window.start").alias("metric_date"), "tenant_id", "job_type",
        "total_jobs", "succeeded_jobs", "failed_jobs", "gpu_hours_u", "cpu_hours_u", "cost_usd_u",
    )


def start_daily_totals(
    totals: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write every version of a changed day, marked with its batch id.

    Update mode keeps only open days in the state. A replayed batch overwrites
    the folder of the same batch id, so versions are never doubled.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = totals.writeStream.outputMode("update").foreachBatch(write)
    query = query.option("checkpointLocation", checkpoint)
    query = query.trigger(processingTime=every) if every else query.trigger(availableNow=True)
    return query.start()


def latest_totals(versions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The newest version of each day, tenant and job type, in rounded units."""
    newest = top_per(versions, list(keys), [F.col("batch_id").desc()], 1)
    return newest.select(
        *keys, "total_jobs", "succeeded_jobs", "failed_jobs",
        *[
            rnd(from_units(f"{c}_u"), 4).alias(f"total_{c}")
            for c in ("gpu_hours", "cpu_hours", "cost_usd")
        ],
    )
