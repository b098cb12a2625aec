"""Which keys a table holds: sorted runs of keys, each with a Bloom filter, folded level by level.

Every insert leaves one run. ``FAN`` runs of a level are merged into one of the next, so a table of any age
has a handful of runs, and a key is rewritten once a level. A run lies in buckets by hash prefix, of about
``bucket_keys`` keys each; a bucket is one file sorted by key, and beside it stand the filter's words.

A batch is looked up in three steps, each on what the one before has left: runs whose smallest and largest
key leave out the batch's range are not opened (ids that grow with time never open an old run); of the others
only the words of the batch's buckets are read, under two bytes a key; and only buckets in which
a word matched are read for an exact comparison. A batch of new keys so reads words only, at most one bucket's
for each of its keys, whatever the size of the table.

The filter is a table, not an object: a word is 64 bits for the keys that share a hash prefix (``slot``), and a key
sets four of them. Testing is an equi-join on the slot, so it is spread like any other join.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import together
from .manifests import Manifest

#: Runs of a level that are folded into one; keys of a bucket; keys that share a word of the filter.
FAN, BUCKET_KEYS, SLOT_KEYS = 8, 1 << 17, 5
#: The highest level an insert folds by itself; beyond it, :meth:`KeyIndex.fold` is for a job of its own.
INLINE_LEVELS = 3
_OPEN = "open"
_MASK = " | ".join(f"shiftleft(1L, cast(shiftright(h, {6 * i}) & 63 AS INT))" for i in range(4))


def _prefix(bits: int | Column) -> Column:
    """The first bits of the hash; 0 of none."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    return F.when(bits == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", F.col("h"), (F.lit(64) - bits).cast("int"))
    )


def _bits(n: float) -> int:
    return max(0, math.ceil(math.log2(n))) if n > 1 else 0


class KeyIndex:
    """The keys of one table, under ``folder``. One writer at a time, as a stream's batches are."""

    def __init__(self, spark: SparkSession, folder: str, key: str, bucket_keys: int = BUCKET_KEYS):
        self.spark, self.folder, self.key, self.bucket_keys = spark, folder, key, bucket_keys
        self.manifest = Manifest(spark, f"{folder}/runs")
        self.version, content = self.manifest.read()
        content = content or {"runs": [], "old": []}
        self.runs: list[dict[str, Any]] = content["runs"]
        self._old: list[str] = content["old"]
        #: Files groups opened by the last lookup: (kind, run, bucket).
        self.opened: list[tuple[str, str, int]] = []

    # --- what a crash leaves ------------------------------------------------

    def begin(self) -> None:
        """Say that rows are about to be written whose keys are not here yet."""
        self.manifest.mark(_OPEN)

    def interrupted(self) -> bool:
        """Whether rows may have been written without their keys."""
        return self.manifest.marked(_OPEN)

    # --- looking up ---------------------------------------------------------

    def _read(self, kind: str, places: Iterable[tuple[str, int]], schema: str) -> DataFrame | None:
        places = sorted(places)
        self.opened += [(kind, *p) for p in places]
        base = f"{self.folder}/{kind}"
        paths = [f"{base}/run={run}/bucket={bucket}" for run, bucket in places]
        if not paths:
            return None
        return self.spark.read.schema(f"{schema}, run STRING, bucket BIGINT").option("basePath", base).parquet(*paths)

    def _hashed(self, rows: DataFrame) -> DataFrame:
        key = F.col(self.key).cast("string")
        return rows.select(key.alias(self.key)).filter(key.isNotNull()).withColumn("h", F.xxhash64(self.key))

    def _touched(self, rows: DataFrame, runs: list[dict]) -> list[tuple[str, int]]:
        """(run, bucket) of the runs' buckets that the keys fall into; only bucket numbers come to the driver."""
        wanted: dict[int, set[int]] = {0: {0}}
        split = sorted({r["bits"] for r in runs} - {0})
        if split:
            numbers = F.array(*[F.struct(F.lit(b).alias("bits"), _prefix(b).alias("bucket")) for b in split])
            for r in rows.select(F.explode(numbers).alias("x")).select("x.*").distinct().collect():
                wanted.setdefault(r.bits, set()).add(r.bucket)
        return [(r["name"], b) for r in runs for b in wanted.get(r["bits"], set()) & set(r["buckets"])]

    def known(self, batch: DataFrame) -> DataFrame | None:
        """The keys of ``batch`` that the index holds, as a frame of one column; None where it surely holds none."""
        self.opened = []
        rows = self._hashed(batch)
        span = rows.agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi")).first()
        runs = [r for r in self.runs if span.lo is not None and r["lo"] <= span.hi and r["hi"] >= span.lo]
        if not runs:
            return None
        words = self._read("words", self._touched(rows, runs), "slots INT, slot BIGINT, word BIGINT")
        if words is None:
            return None
        shapes = F.explode(F.array(*[F.lit(s) for s in sorted({r["slots"] for r in runs})]))
        probes = rows.select(self.key, "h", F.expr(_MASK).alias("mask"), shapes.alias("slots"))
        probes = probes.withColumn("slot", _prefix(F.col("slots")))
        hits = probes.join(words, ["slots", "slot"]).filter(F.expr("(word & mask) = mask"))
        places = [(r.run, r.bucket) for r in hits.select("run", "bucket").distinct().collect()]
        keys = self._read("keys", places, f"{self.key} STRING")
        if keys is None:
            return None
        return rows.select(self.key).join(keys.select(self.key), self.key, "left_semi")

    # --- writing ------------------------------------------------------------

    def _write_run(self, keys: DataFrame, level: int) -> dict[str, Any] | None:
        """Write distinct keys as a run; the run counts from the next commit on."""
        rows = self._hashed(keys)
        found = rows.agg(F.count(F.lit(1)).alias("n"), F.min(self.key).alias("lo"), F.max(self.key).alias("hi")).first()
        if not found.n:
            return None
        bits, slots = _bits(found.n / self.bucket_keys), _bits(found.n / SLOT_KEYS)
        name = uuid.uuid4().hex
        rows = rows.withColumn("bucket", _prefix(bits))
        dealt = rows.repartition(1) if bits == 0 else rows.repartition("bucket")
        dealt = dealt.select(self.key, "bucket").sortWithinPartitions("bucket", self.key)
        words = rows.groupBy("bucket", _prefix(slots).alias("slot")).agg(F.bit_or(F.expr(_MASK)).alias("word"))
        words = words.repartition(1) if bits == 0 else words.repartition("bucket")
        words = words.select(F.lit(slots).alias("slots"), "slot", "word", "bucket").sortWithinPartitions("bucket", "slot")
        together(
            lambda: dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/keys/run={name}"),
            lambda: words.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/words/run={name}"),
        )
        folder = self.manifest._path(f"{self.folder}/words/run={name}")
        names = (f.getPath().getName() for f in self.manifest.fs.listStatus(folder))
        buckets = sorted(int(x[7:]) for x in names if x.startswith("bucket="))
        return {"name": name, "level": level, "keys": found.n, "bits": bits, "slots": slots, "lo": found.lo, "hi": found.hi, "buckets": buckets}

    def _commit(self, runs: list[dict[str, Any]]) -> None:
        """Make these the runs. What the commit before replaced is deleted now: no lookup still reads it."""
        gone = [r["name"] for r in self.runs if r not in runs]
        self.manifest.commit(self.version, {"runs": runs, "old": gone})
        for name in self._old:
            for kind in ("keys", "words"):
                self.manifest.remove(f"{self.folder}/{kind}/run={name}")
        self.version, self.runs, self._old = self.version + 1, runs, gone

    def add(self, keys: DataFrame, inline_levels: int = INLINE_LEVELS) -> None:
        """Add keys that are not in the index yet, each once, and fold the levels that are full."""
        run = self._write_run(keys, 0)
        if run is not None:
            self._commit([*self.runs, run])
        self.manifest.unmark(_OPEN)
        self.fold(inline_levels)

    def fold(self, upto: int | None = None) -> None:
        """Merge the runs of each full level into one of the next."""
        level = 0
        while upto is None or level < upto:
            mine = [r for r in self.runs if r["level"] == level]
            if len(mine) >= FAN:
                places = [(r["name"], b) for r in mine for b in r["buckets"]]
                keys = self._read("keys", places, f"{self.key} STRING").select(self.key).distinct()
                merged = self._write_run(keys, level + 1)
                self._commit([*(r for r in self.runs if r not in mine), merged])
            if level >= max((r["level"] for r in self.runs), default=0):
                return
            level += 1

    def keys(self) -> DataFrame | None:
        """All keys."""
        found = self._read("keys", [(r["name"], b) for r in self.runs for b in r["buckets"]], f"{self.key} STRING")
        return None if found is None else found.select(self.key)
