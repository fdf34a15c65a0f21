"""Numbered manifests: small JSON files of which the last one says what there is.

A commit creates the next number and fails if it is taken, so of several writers one wins and the others see it.  A manifest that a crash left incomplete is skipped.  Any file system that Spark can write will do whose create without overwriting
is exclusive.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has committed first."""


class Manifests:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self.root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self.path, f"{number:012d}.json")

    def numbers(self) -> list[int]:
        """All numbers that are taken, ascending."""
        if not self.fs.exists(self.root):
            return []
        names = (s.getPath().getName() for s in self.fs.listStatus(self.root))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def read(self, number: int) -> dict | None:
        """A manifest's content; None if it is incomplete."""
        stream = self.fs.open(self._at(number))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def latest(self) -> tuple[int, dict]:
        """(number, content) of the last complete manifest; (-1, {}) if there is none."""
        for n in reversed(self.numbers()):
            content = self.read(n)
            if content is not None:
                return n, content
        return -1, {}

    def commit(self, number: int, content: dict) -> None:
        """Take a number for the content."""
        taken = self.numbers()
        if taken and taken[-1] >= number:
            raise Conflict(f"{self.path}: {taken[-1]} is committed already")
        try:
            out = self.fs.create(self._at(number), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception.getClass().getName()):
                raise Conflict(f"{self.path}: {number} is committed already") from e
            raise
        out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        out.close()

    def bytes_below(self, path: str) -> int:
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return self.fs.getContentSummary(at).getLength() if self.fs.exists(at) else 0

    def delete(self, path: str) -> None:
        self.fs.delete(self._jvm.org.apache.hadoop.fs.Path(path), True)

    def children(self, path: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of a folder's entries."""
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
