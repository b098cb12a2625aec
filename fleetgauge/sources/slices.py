"""Tables whose slices are replaced as a whole: all slices of a call at once, or none of them.

A replacement is a part: its rows, and the list of the slices it speaks for. A slice's rows are those of the newest
part that lists it, so a slice that is listed without rows is gone. The part counts from the moment a new version of the
manifest names it; a reader plans with one version and sees the slices as they were before or after, never between. What a
crash leaves behind belongs to no version and is removed by the next writer.

Parts are folded level by level like the runs of a key index, so few are read and a row is rewritten once a level. Neither
rows nor slices pass the driver: staged slices are a small table whose size Catalyst knows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .manifests import Manifest

#: Parts of a level that are folded into one.
FAN = 8
#: Bytes of a row group: small ones let a day be read by itself.
ROW_GROUP = 8 << 20


class SliceTable:
    """Rows of ``schema`` in slices by ``keys``, the first of which is a date. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder, schema, tuple(keys)
        number = T.StructField("_part", T.LongType())
        self._row = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), number])
        self._slice = T.StructType([*(T.StructField(k, schema[k].dataType) for k in keys), number])
        self.manifest = Manifest(spark, f"{folder}/parts")
        self.version, content = self.manifest.read()
        content = content or {"parts": [], "old": []}
        self.parts: list[dict[str, Any]] = content["parts"]
        self._old: list[str] = content["old"]

    def exists(self) -> bool:
        return self.version > 0

    def replace(self, slices: DataFrame, rows: Callable[[DataFrame], DataFrame]) -> None:
        """Make ``rows(slices)`` all that the listed slices hold. Rows of other slices do not count."""
        self._sweep()
        number = max((p["number"] for p in self.parts), default=0) + 1
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        found = self._stage(slices.select(*self.keys).distinct(), path, number)
        if not found["n"]:
            self.manifest.remove(path)
            return
        staged = self._read("slices", [path]).drop("_part")
        self._store(rows(staged), path, number)
        self._commit([*self.parts, found | {"path": path, "level": 0, "number": number}])
        self.fold()

    def fold(self) -> None:
        """Merge the parts of each full level into one of the next; what newer ones replaced goes."""
        level = 0
        while level <= max((p["level"] for p in self.parts), default=-1):
            mine = [p for p in self.parts if p["level"] == level]
            if len(mine) >= FAN:
                number, path = max(p["number"] for p in mine), f"{self.folder}/data/{uuid.uuid4().hex}"
                live, listed = self._live(mine), self._read("slices", [p["path"] for p in mine])
                self._store(live, path, number)
                # Without older parts there is nothing left that a slice without rows would have to hide.
                oldest = min(p["number"] for p in self.parts) == min(p["number"] for p in mine)
                kept = self._read("rows", [path]) if oldest else listed
                found = self._stage(kept.select(*self.keys).distinct(), path, number)
                rest = [p for p in self.parts if p not in mine]
                self._commit(sorted([*rest, found | {"path": path, "level": level + 1, "number": number}], key=lambda p: p["number"]))
            level += 1

    def read(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Rows of the slices of the given days; parts without such slices are not opened."""
        parts = [
            p for p in self.parts
            if p["gaps"] or p["lo"] is None or ((since is None or p["hi"] >= since.isoformat()) and (until is None or p["lo"] <= until.isoformat()))
        ]
        return self._live(parts, since, until).select(*self.schema.names)

    def _live(self, parts: list[dict[str, Any]], since: date | None = None, until: date | None = None) -> DataFrame:
        rows, listed, day = self._read("rows", [p["path"] for p in parts]), self._read("slices", [p["path"] for p in parts]), F.col(self.keys[0])
        for test in ([day >= F.lit(since)] if since else []) + ([day <= F.lit(until)] if until else []):
            rows, listed = rows.filter(test), listed.filter(test)
        newest = listed.groupBy(*[F.col(k).alias(f"_{k}") for k in self.keys]).agg(F.max("_part").alias("_newest"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        return rows.join(newest, [*same, F.col("_part") == F.col("_newest")], "left_semi")

    def _read(self, kind: str, paths: list[str]) -> DataFrame:
        schema = self._row if kind == "rows" else self._slice
        return self.spark.read.schema(schema).parquet(*[f"{p}/{kind}" for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def _store(self, rows: DataFrame, path: str, number: int) -> None:
        # Rebalanced by slice and sorted by it: a row group holds few days, and AQE splits a slice too large for a task.
        rows = rows.select(*self.schema.names, F.lit(number).cast("long").alias("_part"))
        rows = rows.hint("rebalance", *self.keys).sortWithinPartitions(*self.keys)
        rows.write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/rows")

    def _stage(self, slices: DataFrame, path: str, number: int) -> dict[str, Any]:
        """Write the list of slices; their number, first and last day, and whether some have no day."""
        seen, day = Observation(), F.col(self.keys[0])
        stats = (
            F.count(F.lit(1)).alias("n"), F.min(day).cast("string").alias("lo"), F.max(day).cast("string").alias("hi"),
            F.coalesce(F.bool_or(day.isNull()), F.lit(False)).alias("gaps"),
        )
        marked = slices.withColumn("_part", F.lit(number).cast("long"))
        marked.hint("rebalance").observe(seen, *stats).write.parquet(f"{path}/slices")
        return dict(seen.get)

    def _commit(self, parts: list[dict[str, Any]]) -> None:
        gone = [p["path"] for p in self.parts if p not in parts]
        self.manifest.commit(self.version, {"parts": parts, "old": gone})
        for path in self._old:
            self.manifest.remove(path)
        self.version, self.parts, self._old = self.version + 1, parts, gone

    def _sweep(self) -> None:
        """Remove what a crashed writer left: folders that neither this version nor the last one names."""
        for path in self.manifest.folders(f"{self.folder}/data"):
            if path not in {p["path"] for p in self.parts} | set(self._old):
                self.manifest.remove(path)
