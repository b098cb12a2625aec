"""Helpers of the operators: written cuts, a bounded id filter, rows of shared keys, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the id filter; its table has BITS / 64 rows at most, whatever the input.
BITS = 1 << 25


def work_folder(spark) -> str:
    """The shared folder of spark.checkpoint.dir; a folder of its own only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Settings of a cut: a query's shuffle files go when it has ended; rows go to Python in batches of so many bytes, not of 10,000 texts.
_CUT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}


def cut(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, so nothing above it runs again.

    The shuffle files behind it are of no use any more and go when the write has ended.
    """
    spark = df.sparkSession
    path, before = f"{work_folder(spark)}/llm-{uuid.uuid4().hex}", {k: spark.conf.get(k) for k in _CUT}
    try:
        for name, value in _CUT.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `limit` bytes of text each, one row at least: bounded memory."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.array(pc.fill_null(pc.binary_length(column(batch, text)), 0), dtype=np.int64)
        part = (np.cumsum(size) - size) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            yield batch.slice(lo, hi - lo)


def maybe_in(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of df whose key may be among the single column of ids: all true ones, few others.

    A bit per hashed id, kept as rows (word, bits). The table is broadcast: it has BITS / 64 rows
    at most (8 MB), however many ids there are. An exact join has to follow.
    """
    slot = F.pmod(F.xxhash64(ids.columns[0]), F.lit(BITS))
    words = ids.select((slot / 64).cast("long").alias("__word"), (slot % 64).cast("int").alias("__bit"))
    words = words.groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    mine = F.pmod(F.xxhash64(key), F.lit(BITS))
    marked = df.withColumns({"__word": (mine / 64).cast("long"), "__bit": (mine % 64).cast("int")})
    hit = marked.join(F.broadcast(cut(words)), "__word")
    return hit.filter(F.expr("(shiftrightunsigned(__bits, __bit) & 1L) = 1L")).drop("__word", "__bit", "__bits")


def marked(key: np.ndarray) -> np.ndarray:
    """Keys of a slice's rows with their lowest two bits set for rows_of_shared_keys().

    0: the slice has the key once. Of a key that it has more often, one row gets 1 and the others 2.
    """
    order = np.argsort(key)
    k = key[order] >> np.uint64(2)
    again = np.zeros(len(k) + 1, bool)
    again[1:-1] = k[1:] == k[:-1]
    out = np.empty_like(key)
    out[order] = (k << np.uint64(2)) + np.where(again[:-1], 2, again[1:]).astype(np.uint64)
    return out


def rows_of_shared_keys(rows: DataFrame, node: str) -> DataFrame:
    """Rows (key, node, ...) whose key more than one row has; their lowest two bits are cleared.

    One row of a slice goes where its key belongs. The slice's others are sure to share the key and
    go anywhere: a key that a third of all rows have is a row per slice in its partition. Sorted
    partitions stream by in constant memory.
    """
    place = F.when(F.col("key").bitwiseAND(F.lit(3)) == 2, F.xxhash64("key", node)).otherwise(F.shiftright("key", 2))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far, whose successor is not known yet
        held_stays, last = True, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.asarray(column(batch, "key"))
            sure, keys = (keys & 3) != 0, keys >> 2
            batch = batch.set_column(batch.schema.get_field_index("key"), "key", pa.array(keys << 2))
            same = np.zeros(len(keys) + 1, dtype=bool)
            same[1:-1] = keys[1:] == keys[:-1]
            if held is not None:
                same[0] = keys[0] == last
                if held_stays or same[0]:
                    yield held
            stays = same[:-1] | same[1:] | sure
            yield batch.slice(0, len(keys) - 1).filter(pa.array(stays[:-1]))
            held, held_stays, last = batch.slice(len(keys) - 1), bool(stays[-1]), keys[-1]
        if held is not None and held_stays:
            yield held

    return rows.repartition(place).sortWithinPartitions("key").mapInArrow(shared, rows.schema)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected links; only linked nodes.

    Alternates two star steps until nothing changes: neighbours above a node move to its smallest
    neighbour, then the others do. Both aggregate before they shuffle and join on the node, where
    Spark splits skew, so a node with a third of all links is no single task's work.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, before = cut(edges), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.filter("u <> v").distinct())
        sums = [F.count("*"), *(F.sum(F.xxhash64("u", "v") % F.lit(m)) for m in (1_000_003, 998_244_353))]
        now = edges.agg(*sums).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def total(parts: list):
    return reduce(lambda x, y: x + y, parts)
