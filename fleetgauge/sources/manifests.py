"""Small versioned lists on any Hadoop file system: the newest complete one is what holds."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

#: Older versions that stay readable for a while.
KEPT = 3


class Manifest:
    """JSON documents ``<folder>/<number>.json``; one writer, any number of readers.

    A version appears by a rename, so a reader sees the old one or the new one. What a commit replaces is
    deleted by a later commit, when no reader can still be planning with it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self._path(self.folder).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _versions(self) -> list[int]:
        folder = self._path(self.folder)
        if not self.fs.exists(folder):
            return []
        names = (f.getPath().getName() for f in self.fs.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self) -> tuple[int, Any]:
        """(version, content); (0, None) before the first commit."""
        found = self._versions()
        if not found:
            return 0, None
        stream = self.fs.open(self._path(f"{self.folder}/{found[-1]}.json"))
        try:
            return found[-1], json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, version: int, content: Any) -> None:
        """Make ``content`` the version after ``version``."""
        draft, final = (self._path(f"{self.folder}/{name}") for name in (f"_{version + 1}", f"{version + 1}.json"))
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if not self.fs.rename(draft, final):
            raise OSError(f"version {version + 1} of {self.folder} exists already")
        for old in self._versions()[:-KEPT]:
            self.fs.delete(self._path(f"{self.folder}/{old}.json"), False)

    def mark(self, name: str) -> None:
        self.fs.create(self._path(f"{self.folder}/{name}"), True).close()

    def marked(self, name: str) -> bool:
        return self.fs.exists(self._path(f"{self.folder}/{name}"))

    def unmark(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.folder}/{name}"), False)

    def folders(self, parent: str) -> list[str]:
        """Paths of the entries of a folder, spelled as ``parent`` is."""
        at = self._path(parent)
        return [f"{parent}/{f.getPath().getName()}" for f in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)
