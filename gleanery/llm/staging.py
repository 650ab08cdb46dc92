"""Shared-folder staging: tables that outlive the executor that wrote them.

Every intermediate table goes to the folder named by ``spark.checkpoint.dir``,
which the driver and all executors see. Lineage is cut by writing and rereading
Parquet, so a lost executor costs a reread, not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The shared folder. A local session without the setting gets its own
    temporary folder; a cluster without it is an error."""
    root = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {_SETTING} to a folder that driver and executors share")
    root = "file://" + tempfile.mkdtemp(prefix="gleanery-stage-")
    spark.conf.set(_SETTING, root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/gleanery/{name}-{uuid.uuid4().hex}"


@contextmanager
def _own_shuffles_end(spark: SparkSession) -> Iterator[None]:
    """While a staged table is written, Spark deletes each job's shuffle files when the job has
    ended: the table is what later steps read. Versions without the setting delete them later."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with _own_shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def stage_bucketed(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Like ``stage``, in as many buckets by ``keys`` as shuffles have partitions: later
    joins on ``keys`` move the other side only. The catalog entry that buckets need is there
    while the table is written and opened, no longer."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    table = f"gleanery_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        with _own_shuffles_end(spark):
            df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, *keys).saveAsTable(table)
        out = spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: its files stay
    out._staged = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    _delete(df.sparkSession, df._staged)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete everything this package staged in the shared folder."""
    _delete(spark, f"{shared_root(spark)}/gleanery")
