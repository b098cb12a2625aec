"""Writing: idempotent inserts, slice replacement, appends, compaction, CSV, topics.

Plain Parquet has no keys, so "insert or ignore" is: keep the first row per
key inside the batch, drop keys the table already holds, append the rest.
What it holds is told by an index of keys (:mod:`.key_index`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import PARTITIONS
from .dimensions import literal_table
from .events import read_table, slice_table, table_exists
from .key_index import KeyIndex


def first_per_key(batch: DataFrame, key: str, order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by content, so always the same one.

    ``row_number() = 1`` lets Spark keep one row per key on the map side
    (WindowGroupLimit), so a key copied a billion times costs one row per task.
    """
    content = F.xxhash64(*[F.col(c) for c in batch.columns])
    w = W.partitionBy(key).orderBy(*order, content)
    return batch.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def touched_slices(batch: DataFrame, columns: Sequence[str] = PARTITIONS["job_events"]) -> DataFrame:
    """The distinct (day, tenant) slices a batch has rows in."""
    return batch.select(*columns).distinct()


def touched_days(batch: DataFrame, column: str) -> Column:
    """A constant predicate on a date partition: the days ``batch`` has rows of.

    Only distinct days come to the driver. The predicate prunes partitions while planning.
    """
    days = [r[0] for r in batch.select(column).distinct().collect()]
    test = F.col(column).isin([d for d in days if d is not None])
    return test | F.col(column).isNull() if None in days else test


def pinned(slices: DataFrame) -> DataFrame:
    """The slices as a literal table: partition names only, so Catalyst knows their size.

    A semi-join with it is a broadcast where it is small and shuffles where it is not.
    """
    return literal_table(slices.sparkSession, slices.collect(), slices.schema)


def new_rows(
    batch: DataFrame, target: DataFrame | None, key: str, order: Sequence[Column] = ()
) -> DataFrame:
    """Rows of ``batch`` whose key is neither repeated in it nor present in ``target``.

    The batch is already distributed by key when it meets the target, so only
    the key column of the target moves for the comparison.
    """
    first = first_per_key(batch, key, order)
    return first if target is None else first.join(target.select(key), key, "left_anti")


def _write(df: DataFrame, path: str, partitions: Sequence[str], mode: str) -> None:
    # Rebalance groups rows by slice; AQE splits a slice that is too large for
    # one task and merges the small ones, so file sizes stay even under skew.
    writer = df.hint("rebalance", *partitions).write.mode(mode).partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def key_index(spark: SparkSession, root: str, table: str, key: str) -> KeyIndex:
    return KeyIndex(spark, f"{root}/{table}_keys", key)


def append_new(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    table: str,
    key: str,
    order: Sequence[Column] = (),
    unique: bool = False,
    held: bool = False,
    before: Callable[[DataFrame], None] | None = None,
) -> None:
    """Insert or ignore into a stored table: a key is stored once, whatever its day.

    Rows are written before their keys, between two marks. Only when a run finds the first mark without the second,
    after a crash, are the days of its batch compared in the table itself: the same rows come again, with
    the same days. ``unique``: the batch has no key twice. ``held``: it is cached or read from what is, so only what is new in it
    is kept again, and only where a lookup has told it. ``before`` is called with the rows that are new, before
    any of them is written; after a crash it is called again, with those that are still new.
    """
    path, partitions = f"{root}/{table}", PARTITIONS[table]
    first = batch if unique else first_per_key(batch, key, order)
    kept = [] if held else [first.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        index = key_index(spark, root, table, key)
        stored = table_exists(spark, path)
        if stored and not index.runs and not index.interrupted():
            index.add(read_table(spark, root, table).select(key).distinct())  # a table older than its index
        known = index.known(first)
        unknown = first if known is None else first.join(known, key, "left_anti")
        if held and known is not None:  # else every use of the rows would look the keys up again
            kept.append(unknown.persist(StorageLevel.MEMORY_AND_DISK))
        fresh = unknown
        if stored and index.interrupted():
            held = read_table(spark, root, table).filter(touched_days(first, partitions[0])).select(key)
            fresh = unknown.join(held, key, "left_anti")
        if before is not None:
            before(unknown)
        index.begin()
        _write(fresh, path, partitions, "append")
        index.add(unknown.select(key))
    finally:
        for rows in kept:
            rows.unpersist()


def compact(spark: SparkSession, root: str, table: str, day: date) -> None:
    """Rewrite the files of one day, so that micro-batches leave few behind.

    The new files replace the old ones when they are complete; a run that fails leaves the day as it was.
    """
    first = PARTITIONS[table][0]
    _write(read_table(spark, root, table).filter(F.col(first) == F.lit(day)), f"{root}/{table}", PARTITIONS[table], "overwrite")


def replace_slices(spark: SparkSession, slices: DataFrame, rows: Callable[[DataFrame], DataFrame], root: str, table: str) -> None:
    """Make ``rows(slices)`` all that the (day, tenant) slices of a table hold, in one commit.

    A table of plain partitions from before is taken over first.
    """
    held = slice_table(spark, root, table)
    if not held.exists() and table_exists(spark, f"{root}/{table}"):
        plain = read_table(spark, root, table)
        held.replace(plain.select(*PARTITIONS[table]), lambda _: plain)
    held.replace(slices, rows)


def overwrite_slices(df: DataFrame, root: str, table: str) -> None:
    """Replace exactly the (day, tenant) slices that ``df`` has rows for."""
    replace_slices(df.sparkSession, df.select(*PARTITIONS[table]), lambda _: df, root, table)


def drop_slices(spark: SparkSession, slices: DataFrame, root: str, table: str) -> int:
    """Remove whole slices of a table of plain partitions, as when its oldest days expire.

    Only partition names are listed here, never rows; a slice without a name is no slice of a table.
    """
    partitions = PARTITIONS[table]
    slices = slices.select(*partitions).dropna().distinct()
    hadoop = spark._jvm.org.apache.hadoop.fs
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    dropped = 0
    for row in slices.collect():
        parts = "/".join(f"{c}={escape(str(row[c]))}" for c in partitions)
        path = hadoop.Path(f"{root}/{table}/{parts}")
        dropped += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def append(df: DataFrame, root: str, table: str) -> None:
    """Plain append, for log tables such as the digests."""
    _write(df, f"{root}/{table}", PARTITIONS[table], "append")


def export_csv(df: DataFrame, path: str) -> None:
    """Folder of CSV files with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def to_payload(df: DataFrame, key: str = "tenant_id") -> DataFrame:
    """Rows as (key, value) messages: the tenant as key, the whole row as JSON."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish(df: DataFrame, servers: str, topic: str, key: str = "tenant_id") -> None:
    """Send rows to a topic, keyed by tenant, acknowledged by all replicas."""
    writer = to_payload(df, key).write.format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer.option("kafka.acks", "all").option("kafka.retries", "3").save()
