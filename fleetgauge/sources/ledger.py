"""Mergeable rows kept beside the events: what periodic jobs need, added to by every batch.

A ledger holds sums and maxima per key. A batch adds a part with what it brings, and parts are folded level by
level like the runs of a key index, so neither reading nor writing ever goes back to the events. A part is sorted by its date
column: a reader of a few days skips the other parts by their range, and the row groups of the rest.

A part bears the name of its batch's content and is written before the batch's rows are. A batch that comes
again after a crash finds its name and changes nothing, whatever of its rows was stored by then.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dimensions import literal_table
from .manifests import Manifest

#: Parts of a level that are folded into one; names remembered for batches that come again.
FAN, REMEMBERED = 8, 256
#: Bytes of a row group: small ones let a day be read by itself.
ROW_GROUP = 8 << 20


@dataclass(frozen=True)
class Shape:
    """Keys, additive columns, columns of which the largest counts, and the date among the keys."""

    schema: T.StructType
    keys: tuple[str, ...]
    day: str
    maxima: tuple[str, ...] = ()

    def merged(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in self.schema.names if c not in self.keys and c not in self.maxima]
        return rows.groupBy(*self.keys).agg(*sums, *[F.max(c).alias(c) for c in self.maxima])


class Ledger:
    """One table of mergeable rows under ``folder``. One writer at a time."""

    def __init__(self, spark: SparkSession, folder: str, shape: Shape):
        self.spark, self.folder, self.shape = spark, folder, shape
        self.manifest = Manifest(spark, f"{folder}/parts")
        self.version, content = self.manifest.read()
        content = content or {"parts": [], "old": [], "names": []}
        self.parts: list[dict[str, Any]] = content["parts"]
        self._old, self._names = content["old"], content["names"]

    def exists(self) -> bool:
        return self.version > 0

    def has(self, name: str) -> bool:
        """Whether the batch of this name has been added."""
        return name in self._names

    def _write(self, rows: DataFrame, level: int) -> dict[str, Any] | None:
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        day = self.shape.day
        # Observed where the files are written: a task counts when it has succeeded, and then once.
        seen = Observation()
        stats = (F.min(day).cast("string").alias("lo"), F.max(day).cast("string").alias("hi"), F.count(F.lit(1)).alias("n"))
        rows = self.shape.merged(rows).select(*self.shape.schema.names).hint("rebalance", day).sortWithinPartitions(day)
        rows.observe(seen, *stats).write.option("parquet.block.size", ROW_GROUP).parquet(path)
        found = seen.get
        return {"path": path, "level": level, "rows": found["n"], "lo": found["lo"], "hi": found["hi"]} if found["n"] else None

    def _commit(self, parts: list[dict[str, Any]], names: list[str]) -> None:
        gone = [p["path"] for p in self.parts if p not in parts]
        self.manifest.commit(self.version, {"parts": parts, "old": gone, "names": names[-REMEMBERED:]})
        for path in self._old:
            self.manifest.remove(path)
        self.version, self.parts, self._old, self._names = self.version + 1, parts, gone, names[-REMEMBERED:]

    def add(self, name: str, rows: DataFrame) -> None:
        """Add a batch's rows once; later calls with the same name change nothing."""
        if self.has(name):
            return
        part = self._write(rows, 0)
        self._commit([*self.parts, *([part] if part else [])], [*self._names, name])
        self.fold()

    def fold(self) -> None:
        """Merge the parts of each full level into one of the next."""
        level = 0
        while level <= max((p["level"] for p in self.parts), default=-1):
            mine = [p for p in self.parts if p["level"] == level]
            if len(mine) >= FAN:
                merged = self._write(self._scan(mine), level + 1)
                self._commit([*(p for p in self.parts if p not in mine), merged], self._names)
            level += 1

    def _scan(self, parts: list[dict[str, Any]]) -> DataFrame:
        if not parts:
            return literal_table(self.spark, [], self.shape.schema)
        return self.spark.read.schema(self.shape.schema).parquet(*[p["path"] for p in parts])

    def read(self, since: date | None = None, until: date | None = None, days: Sequence[date] | None = None) -> DataFrame:
        """Rows of the given days, several to a key; add them up with ``shape.merged``."""
        if days is not None:
            since, until = (min(days), max(days)) if days else (date.max, date.min)
        parts = [
            p for p in self.parts
            if p["lo"] is None or ((since is None or p["hi"] >= since.isoformat()) and (until is None or p["lo"] <= until.isoformat()))
        ]
        rows, day = self._scan(parts), F.col(self.shape.day)
        if since is not None:
            rows = rows.filter(day >= F.lit(since))
        if until is not None:
            rows = rows.filter(day <= F.lit(until))
        return rows if days is None else rows.filter(day.isin(list(days)))
