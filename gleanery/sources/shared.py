"""Tables written once to the folder that driver and executors share, and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a local session without one uses its own."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix=f"gleanery-{name}-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written and reread: what it took to make them is done once and forgotten."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
