"""Markdown tables in texts, as rows.

Lines are split in the scan, headers are carried forward by a window per stretch of a document, and
cells are bound to roles by the header above them. Several tables may follow each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import strip

ROLES = ["title", "size", "location", "price", "link"]
_SEPARATOR = r"(?U)^\|?[\s:|-]+\|?$"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc, text) per file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), F.col("value").alias("text"))


def cells_of(line: Column) -> Column:
    """The stripped cells of a row; one outer pipe on either side is no cell."""
    bare = F.regexp_replace(F.regexp_replace(strip(line), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(bare, r"\|"), strip)


def roles_of(cells: Column) -> Column:
    """Roles by header cell, or null where the cells are no header."""
    table = dims.literal_map(dims.HEADER_ALIASES)
    roles = F.transform(cells, lambda c: F.try_element_at(table, F.lower(c)))
    titles = F.size(F.filter(roles, lambda r: r.eqNullSafe(F.lit("title"))))
    prices = F.size(F.filter(roles, lambda r: r.eqNullSafe(F.lit("price"))))
    return F.when((titles == 1) & (prices >= 1), roles)


def fit_cells(cells: Column, width: Column) -> Column:
    """Surplus cells are joined into the first; missing ones are empty."""
    surplus = F.size(cells) - width
    joined = F.concat(
        F.array(F.array_join(F.slice(cells, F.lit(1), F.greatest(surplus, F.lit(0)) + 1), " | ")),
        F.slice(cells, F.greatest(surplus, F.lit(0)) + 2, F.size(cells)),
    )
    padded = F.concat(cells, F.array_repeat(F.lit(""), F.greatest(-surplus, F.lit(0))))
    return F.when(surplus > 0, joined).otherwise(padded)


#: Lines of a document that are taken together; of all before them only the last header is known.
STRETCH = 1 << 13


def _with_headers(rows: DataFrame) -> DataFrame:
    """``roles`` and ``source_table``, the last header so far in the row's document and its number. A long
    document is dealt out by its stretches, and each starts from what those before it ended with."""
    ends = rows.groupBy("doc", "part").agg(F.max_by("header", F.when(F.col("header").isNotNull(), F.col("line"))).alias("header"), F.count("header").alias("n"))
    before = Window.partitionBy("doc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        "doc", "part", F.lit(-1).alias("line"), F.lit(None).cast("array<string>").alias("cells"),
        F.last("header", ignorenulls=True).over(before).alias("header"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"),
    )
    order = Window.partitionBy("doc", "part").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.withColumn("n", F.col("header").isNotNull().cast("long")).unionByName(starts)
    return both.withColumns({"roles": F.last("header", ignorenulls=True).over(order), "source_table": F.sum("n").over(order).cast("string")}).where("line >= 0")


def table_rows(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, line, source_table, title, size, location, price, link) of every table row with a title."""
    lines = texts.select(F.col(doc).alias("doc"), F.posexplode(F.split(text, r"\R")).alias("line", "raw"))
    rows = lines.where(F.startswith(strip(F.col("raw")), F.lit("|")) & ~strip(F.col("raw")).rlike(_SEPARATOR))
    rows = rows.withColumn("part", F.floor(F.col("line") / STRETCH)).repartition("doc", "part")  # a document's lines come from one task
    rows = rows.select("doc", "part", "line", cells_of(F.col("raw")).alias("cells")).withColumn("header", roles_of(F.col("cells")))
    bound = _with_headers(rows).where("header is null and roles is not null")
    cells = fit_cells(F.col("cells"), F.size("roles"))
    pairs = F.filter(F.arrays_zip(F.col("roles").alias("r"), cells.alias("c")), lambda p: p["r"].isNotNull())
    by_role = F.map_from_arrays(F.transform(pairs, lambda p: p["r"]), F.transform(pairs, lambda p: p["c"]))
    named = bound.withColumn("by_role", by_role)
    out = named.select("doc", "line", "source_table", *[F.try_element_at("by_role", F.lit(r)).alias(r) for r in ROLES])
    return out.where("title != ''")
