"""Versioned lists of the parts of a table: readers follow the newest list, writers claim the next number."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Manifest:
    """Numbered JSON files ``manifest-N.json`` in a folder of any file system that Spark reaches.

    A version is published by creating its file, which fails where the file exists; so of two writers one has to start again from
    the other's version.  (An object store needs a client that supports exclusive creation.)
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _name(self, version: int) -> str:
        return f"{self.root}/manifest-{version:010d}.json"

    def version(self) -> int:
        """The newest version, 0 before the first."""
        found = self._fs.globStatus(self._path(f"{self.root}/manifest-*.json")) or []
        return max((int(f.getPath().getName()[len("manifest-"):-len(".json")]) for f in found), default=0)

    def read(self) -> tuple[int, list[dict]]:
        version = self.version()
        return version, self.read_version(version)

    def read_version(self, version: int) -> list[dict]:
        """The parts that a version names, none before the first."""
        return json.loads(self.spark.read.text(self._name(version), wholetext=True).first()[0]) if version else []

    def publish(self, version: int, parts: list[dict]) -> None:
        """Make ``parts`` the given version; an error where another writer was first."""
        out = self._fs.create(self._path(self._name(version)), False)
        try:
            out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
        finally:
            out.close()

    def forget(self, keep: int = 1) -> None:
        """Remove all but the newest versions."""
        newest = self.version()
        for f in self._fs.globStatus(self._path(f"{self.root}/manifest-*.json")) or []:
            if int(f.getPath().getName()[len("manifest-"):-len(".json")]) <= newest - keep:
                self._fs.delete(f.getPath(), False)

    def remove(self, part: str) -> None:
        """Remove a part's folder."""
        self._fs.delete(self._path(f"{self.root}/{part}"), True)

    def folders(self) -> list[str]:
        return [f.getPath().getName() for f in self._fs.globStatus(self._path(f"{self.root}/*")) or [] if f.isDirectory()]
