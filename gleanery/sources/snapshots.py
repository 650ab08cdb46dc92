"""A table kept as snapshots: written beside each other, one small file naming the current one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class Snapshots:
    """Snapshots under ``folder``, through the file system that Spark uses for it.

    A reader sees the old snapshot or the new one, never half of either. The snapshot before the
    current one is kept, for readers that began with it; older ones are deleted.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, kind: str) -> list[str]:
        here = self._path(self.folder)
        found = self._fs.listStatus(here) if self._fs.exists(here) else []
        return sorted(n for n in (f.getPath().getName() for f in found) if n.startswith(kind))

    def current(self) -> DataFrame | None:
        """The table, None if there is none yet."""
        marks = self._names("current-")
        return self.spark.read.parquet(f"{self.folder}/snapshot-{marks[-1].partition('-')[2]}") if marks else None

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows``, which may be read off the current snapshot, the current one."""
        marks = self._names("current-")
        at = int(marks[-1].split("-")[1]) + 1 if marks else 0
        name = f"{at:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/snapshot-{name}")
        self._fs.create(self._path(f"{self.folder}/current-{name}")).close()
        kept = {name, *(m.partition("-")[2] for m in marks[-1:])}
        for old in marks[:-1]:
            self._fs.delete(self._path(f"{self.folder}/{old}"), False)
        for old in self._names("snapshot-"):
            if old.partition("-")[2] not in kept and old.partition("-")[2] < name:
                self._fs.delete(self._path(f"{self.folder}/{old}"), True)
