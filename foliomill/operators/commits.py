"""Numbered commits in a shared folder: what a commit names counts, what none names does not."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class ConcurrentRun(RuntimeError):
    """Another run committed to the same folder in the meantime; run again to take up what it left."""


class Commits:
    """A folder whose contents count as far as numbered commits name them.

    A run broken before its commit is done again in full, and of two runs only one can take a number: the file of a commit
    is created only where it does not exist.
    """

    def __init__(self, spark: SparkSession, workdir: str):
        self.spark, self.workdir = spark, workdir
        folder = self.path("commits")
        self.fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.entries: dict[int, dict] = {}
        if self.fs.exists(folder):
            found = {int(s.getPath().getName()): s for s in self.fs.listStatus(folder)}
            self.entries = {n: self._read(found[n]) for n in sorted(found)}

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.workdir}/{name}")

    def _read(self, status) -> dict:
        if not status.getLen():  # its writer broke off; the number is used up
            return {}
        stream = self.fs.open(status.getPath())
        try:
            return json.loads(stream.readUTF())
        finally:
            stream.close()

    def commit(self, **entry) -> None:
        number = max(self.entries, default=0) + 1
        try:
            stream = self.fs.create(self.path(f"commits/{number:08d}"), False)
        except Exception as error:
            raise ConcurrentRun(f"commit {number} of {self.workdir} is taken") from error
        try:
            stream.writeUTF(json.dumps(entry))
        finally:
            stream.close()
        self.entries[number] = entry

    def folders(self, kind: str) -> list[str]:
        return [e[kind] for e in self.entries.values() if e.get(kind)]

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)
