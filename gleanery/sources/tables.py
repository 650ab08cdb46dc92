"""Stored tables: schema evolution, text encodings of nested columns, raw pages as a data source."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def migrate(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that an older layout lacks are added as nulls; others are dropped."""
    empty = rows.sparkSession.createDataFrame([], schema)
    return empty.unionByName(rows.select(*[c for c in rows.columns if c in schema.names]), allowMissingColumns=True)


def encode(listings: DataFrame) -> DataFrame:
    """Nested columns as JSON texts, flags as numbers."""
    return listings.withColumns({
        "image_urls": F.to_json(F.coalesce("image_urls", F.array().cast("array<string>"))),
        "attributes": F.to_json(F.coalesce("attributes", F.create_map().cast("map<string,string>"))),
        "is_promoted": F.col("is_promoted").cast("int"),
    })


def decode(rows: DataFrame) -> DataFrame:
    """The inverse of ``encode``; empty texts are empty values."""
    return rows.withColumns({
        "image_urls": F.from_json(F.coalesce(F.nullif("image_urls", F.lit("")), F.lit("[]")), "array<string>"),
        "attributes": F.from_json(F.coalesce(F.nullif("attributes", F.lit("")), F.lit("{}")), "map<string,string>"),
        "is_promoted": F.coalesce(F.col("is_promoted").cast("boolean"), F.lit(False)),
    })


def saved_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(url, status, html) of a folder of saved pages on any file system that Spark reads: ``<name>.html``
    and, beside it, ``<name>.url`` with the page's address, without which the file's name stands for it."""

    def files(suffix: str) -> DataFrame:
        read = spark.read.text(folder, wholetext=True, pathGlobFilter=f"*.{suffix}")
        return read.select(F.regexp_replace(F.input_file_name(), rf"\.{suffix}$", "").alias("_name"), F.col("value").alias(suffix))

    both = files("html").join(files("url"), "_name", "left")
    address = F.coalesce(F.nullif(F.btrim("url", F.lit(" \t\r\n")), F.lit("")), F.col("_name"))
    return both.select(address.alias("url"), F.lit(200).alias("status"), "html")


class RawPages(DataSource):
    """``spark.read.format("raw_pages").load(folder)``: saved pages as (url, status, html, from_cache).

    A folder holds ``<name>.html`` and, beside it, ``<name>.url`` with the page's address.
    Files are dealt out in ``partitions`` groups.
    """

    @classmethod
    def name(cls) -> str:
        return "raw_pages"

    def schema(self) -> str:
        return "url string, status int, html string, from_cache boolean"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _RawPagesReader(self.options)


class _RawPagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.groups = int(options.get("partitions", "8"))

    def partitions(self) -> list[InputPartition]:
        names = sorted(str(p) for p in Path(self.folder).glob("*.html"))
        return [InputPartition(names[i :: self.groups]) for i in range(min(self.groups, len(names)))] or [InputPartition([])]

    def read(self, partition: InputPartition):
        for name in partition.value:
            address = Path(name).with_suffix(".url")
            url = address.read_text(encoding="utf-8").strip() if address.exists() else name
            yield url, 200, Path(name).read_text(encoding="utf-8", errors="replace"), True


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RawPages)
