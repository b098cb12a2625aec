"""The ingestion stream: lines in, stored events, incidents and daily metrics out.

A micro-batch stays a DataFrame from decoding to the last write. Its lines are parsed once: one shuffle makes events of
copies, and all that follows reads the events it leaves in the cache. Lines without
an id are set aside as rejected; events that break a required column, a value
range or a domain as quarantined, with their reasons. Only the others are
stored. What breaks the expectations is counted while the set-asides are written, and kept
per batch. The order is set-asides, events, then incidents and metrics, and every step may be repeated:
events and incidents are inserted by key, metrics replace whole slices. What
the rules look at is the batch itself, not what the event insert let through,
so a batch replayed after a crash between two steps still raises its
incidents.

Before the rows go in, what is new among them is added to the ledgers: histograms of the days' metrics and
arrivals. Metrics are then refreshed from the histograms, and health and quality jobs read arrivals, so neither
a late event nor a job makes anything read the events of a day again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clock import Moment
from ..operators.incidents import as_stored_incidents, inline_incidents
from ..operators.quality import STORED_SUITE, broken, expectation_rows, quarantine, watched
from ..plans.arrivals import day_ledger, day_rows, stamp_ledger, stamp_rows
from ..plans.metrics import metric_ledger, metric_rows, refresh_from_ledger
from ..session import together
from ..settings import HealthLimits, RuleLimits
from ..sources.events import apply_defaults, as_stored, parse_lines, read_table, rejected_lines, table_exists
from ..sources.ledger import Ledger
from ..sources.sinks import append_new, touched_slices


LEDGERS = ((metric_ledger, metric_rows), (stamp_ledger, stamp_rows), (day_ledger, day_rows))


def add_to_ledgers(spark: SparkSession, root: str, new: DataFrame, name: str) -> None:
    """Add events that are about to be stored. A table older than its ledgers is counted first, once."""

    def add(ledger: Ledger, rows: Callable[[DataFrame], DataFrame]) -> None:
        if not ledger.exists() and table_exists(spark, f"{root}/job_events"):
            ledger.add("history", rows(read_table(spark, root, "job_events")))
        if not ledger.has(name):
            ledger.add(name, rows(new))

    together(*[partial(add, open_ledger(spark, root), rows) for open_ledger, rows in LEDGERS])


def gathered(parsed: DataFrame, now: Moment) -> DataFrame:
    """The one pass over a batch's lines: a row for each event as it is stored, and for each line without an id; ``_copies`` tells how often.

    An event is the first of its copies by emission, then by content, as ``first_per_key`` has it. Copies are added up in their task
    before the shuffle. Lines without an id (``value``) also keep their task apart, so one that comes a billion times has no task of its own.
    """
    no_id = F.col("event_id").isNull()
    order = F.struct(F.col("emitted_at").isNull(), F.col("emitted_at"), F.xxhash64(*parsed.columns))
    rows = parsed.select(
        "event_id", F.when(no_id, F.col("value")).alias("value"), F.when(no_id, F.spark_partition_id()).alias("_task"),
        order.alias("_order"), F.struct(*[c for c in parsed.columns if c not in ("event_id", "value")]).alias("_row"),
    )
    first = rows.groupBy("event_id", "value", "_task").agg(F.min_by("_row", "_order").alias("_row"), F.count(F.lit(1)).alias("_copies"))
    return as_stored(apply_defaults(first.select("event_id", "value", "_copies", "_row.*"), now), keep=("value", "_copies"))


def _rejected(rows: DataFrame) -> DataFrame:
    """The lines without an id, each as often as it came; no array has more than 65536 of them."""
    block = F.explode(F.sequence(F.lit(0), F.expr("(_copies - 1) div 65536")))
    copies = F.expr("explode(sequence(1, least(65536, _copies - _block * 65536)))")
    return rejected_lines(rows.filter(F.col("event_id").isNull()).withColumn("_block", block).withColumn("_copy", copies))


def _told(rows: DataFrame, fails: Column) -> Row:
    """What a batch holds, from one scan of it. ``n``, ``x`` and ``y`` tell its clean events, whatever their order and whatever is stored."""
    named, key = F.col("event_id").isNotNull(), F.xxhash64("event_id")
    clean = named & ~fails
    return rows.agg(
        F.count("event_id").alias("events"), F.coalesce(F.sum(F.when(named, F.col("_copies"))), F.lit(0)).alias("lines"),
        F.count(F.when(~named, 1)).alias("rejected"), F.count(F.when(named & fails, 1)).alias("bad"), F.count(F.when(clean, 1)).alias("n"),
        F.bit_xor(F.when(clean, key)).alias("x"), F.bit_xor(F.when(clean, F.xxhash64(key))).alias("y"),
    ).first()


def make_batch_writer(
    root: str,
    ten: DataFrame,
    as_of: Callable[[int], Moment],
    tenant: str | None = None,
    limits: RuleLimits = RuleLimits(),
    overrun_pct: float = HealthLimits().overrun_pct,
) -> Callable[[DataFrame, int], None]:
    """The foreachBatch function. ``as_of`` gives the arrival time of a batch id."""

    def note(new: DataFrame, name: str) -> None:
        add_to_ledgers(new.sparkSession, root, new, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = as_of(batch_id)
        parsed = parse_lines(batch).withColumn("_batch", F.lit(batch_id))
        if tenant is not None:
            parsed = parsed.filter(F.col("event_id").isNull() | (F.col("tenant_id") == tenant))
        # Cached blocks lost with an executor are rebuilt from the source,
        # whose offsets are fixed for the batch.
        rows = gathered(parsed, now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            told = _told(rows, broken(rows, now, STORED_SUITE))
            events = rows.filter(F.col("event_id").isNotNull()).drop("value", "_copies")
            clean, bad = quarantine(events, now, STORED_SUITE)
            # Only rows that are set aside can break an expectation, so writing them counts for the batch.
            aside, counted = {"rejected": (_rejected(rows), told.rejected), "quarantine": (bad, told.bad)}, {}
            # One folder per batch id that has any: a replay overwrites its own.
            for name, (lines, n) in aside.items():
                if n:
                    lines, seen = watched(lines.withColumn("batch_id", F.lit(batch_id)))
                    lines.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
                    counted = seen.get if name == "quarantine" else counted
            repeats = {"event_id": told.lines - told.events}
            results = expectation_rows(spark, counted, events.columns, repeats)
            results.write.mode("overwrite").parquet(f"{root}/expectations/batch={batch_id}")
            if not told.n:
                return
            batch_name = f"{told.n}-{told.x or 0:x}-{told.y or 0:x}"
            append_new(spark, clean, root, "job_events", "event_id", unique=True, held=True, before=lambda new: note(new, batch_name))
            found = as_stored_incidents(inline_incidents(clean, ten, limits, as_of=now))
            together(
                lambda: append_new(spark, found, root, "incidents", "incident_id", unique=True, held=True),
                lambda: refresh_from_ledger(spark, root, ten, touched_slices(clean), now, overrun_pct=overrun_pct),
            )
        finally:
            rows.unpersist()

    return write


def start_ingest(
    lines: DataFrame,
    writer: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Start the stream; ``every=None`` drains what is available and stops."""
    query = lines.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    query = query.trigger(processingTime=every) if every else query.trigger(availableNow=True)
    return query.start()
