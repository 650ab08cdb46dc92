"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merging import complete, fold


def read_table(spark: SparkSession, folder: str, table: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """A stream of a Parquet table's files."""
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def dedup(stream: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """The first row of each key; state older than the watermark is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Tumbling counts (an extension of ours)."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n"))


def session_counts(stream: DataFrame, time: str, by: list[str], gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Session counts (an extension of ours)."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), *by).agg(F.count(F.lit(1)).alias("n"))


class FoldingSink:
    """``foreachBatch`` target: each batch is folded by key and kept as a delta of its own.

    A batch costs its own rows, not the table's. Every ``COMPACT`` batches all that came so far is
    folded into one base. A batch that is delivered again rewrites its own delta, so the result
    doesn't change. The fold of folds is the fold of all rows, with batches as their order.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def _finished(self, kind: str) -> list[int]:
        """The numbers of the folders of one kind that were written to their end."""
        here = self._path(self.folder)
        fs = here.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(here)] if fs.exists(here) else []
        return sorted(int(n.partition("-")[2]) for n in names if n.startswith(f"{kind}-") and fs.exists(self._path(f"{self.folder}/{n}/_SUCCESS")))

    def _write(self, rows: DataFrame, kind: str, batch: int) -> None:
        rows.withColumn("seq", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.folder}/{kind}-{batch}")

    def current(self, until: int | None = None) -> DataFrame | None:
        """The table as of batch ``until``, the last by default; None before the first."""
        upto = [b for b in self._finished("base") if until is None or b <= until]
        after = upto[-1] if upto else -1
        deltas = [b for b in self._finished("batch") if b > after and (until is None or b <= until)]
        paths = [f"{self.folder}/base-{after}"] * bool(upto) + [f"{self.folder}/batch-{b}" for b in deltas]
        return fold(self.spark.read.parquet(*paths)) if paths else None

    def __call__(self, rows: DataFrame, batch: int) -> None:
        self._write(fold(complete(rows, keep=["seq"])), "batch", batch)
        if batch % self.COMPACT == self.COMPACT - 1:
            self._write(self.current(batch), "base", batch)


def merge_stream(stream: DataFrame, folder: str, checkpoint: str) -> DataFrame | None:
    """Fold all that is available into the table in ``folder``; returns the table."""
    sink = FoldingSink(stream.sparkSession, folder)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sink.current()
