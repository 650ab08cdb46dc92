"""A session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "gleanery", **settings: str) -> SparkSession:
    """UTC everywhere, adaptive plans; the master and sizes are the caller's."""
    builder = SparkSession.builder.appName(name)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for key, value in (fixed | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
