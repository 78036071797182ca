"""Tables that are replaced as a whole, atomically.

A snapshot is a folder of its own below the table's folder. A commit is a small file in `_commits`, named by its number,
that names the snapshot; it is written aside and renamed into place, which either happens or does not, and which fails if
that number is taken. Readers follow the highest commit. A job that dies before the rename leaves the table as it was;
its folder is removed by a later commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_DIGITS = 12


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the table was read."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        path = self._path(self.root)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def version(self) -> int:
        """Number of the last commit; 0 if there is none."""
        return max([int(n) for n in self._names(f"{self.root}/_commits") if n.isdigit()], default=0)

    def _snapshot_of(self, version: int) -> str:
        stream = self._fs.open(self._path(f"{self.root}/_commits/{version:0{_DIGITS}d}"))
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def path(self, version: int | None = None) -> str:
        """Folder of the current snapshot, or of an earlier one that is still kept."""
        version = self.version() if version is None else version
        if not version:
            raise FileNotFoundError(f"{self.root} has no snapshot")
        return f"{self.root}/{self._snapshot_of(version)}"

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.path(version))

    def replace(self, df: DataFrame, expected: int | None = None, keep: int = 2) -> int:
        """Writes df as the new snapshot and returns its version. df may read the current snapshot.

        expected: the version the change was made from; any other commit since makes this one fail. The last `keep`
        snapshots stay for readers that have begun.
        """
        before = self.version() if expected is None else expected
        name = f"snapshot-{before + 1:0{_DIGITS}d}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{name}")
        self._commit(before + 1, name)
        self._forget(before + 1 - keep)
        return before + 1

    def _commit(self, version: int, name: str) -> None:
        aside = self._path(f"{self.root}/_commits/.{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        try:
            stream.writeUTF(name)
        finally:
            stream.close()
        place = self._path(f"{self.root}/_commits/{version:0{_DIGITS}d}")
        if self._fs.exists(place) or not self._fs.rename(aside, place):
            self._fs.delete(aside, False)
            raise ConcurrentCommit(f"version {version} of {self.root} exists")

    def _forget(self, last: int) -> None:
        """Removes commits up to `last` and the folders that no commit names and that are older than the current one."""
        for n in self._names(f"{self.root}/_commits"):
            if n.isdigit() and int(n) <= last:
                self._fs.delete(self._path(f"{self.root}/_commits/{n}"), False)
        current = self.version()
        named = {self._snapshot_of(int(n)) for n in self._names(f"{self.root}/_commits") if n.isdigit()}
        for n in self._names(self.root):
            if n.startswith("snapshot-") and n not in named and int(n.split("-")[1]) <= current:
                self._fs.delete(self._path(f"{self.root}/{n}"), True)
