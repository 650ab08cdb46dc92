"""Robots rules as data: which pages of a table may be read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Statuses of a robots file that close a site; other failures to find one leave it open.
CLOSED = (401, 403)


def origin(url):
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def allowed(pages: DataFrame, rules: DataFrame, files: DataFrame) -> DataFrame:
    """Pages that the longest fitting rule of their origin allows.

    ``rules``: origin, prefix, allow. ``files``: origin, status (null: not reachable, closed).
    Origins that ``files`` doesn't know are closed.
    """
    named = pages.withColumns({"_origin": origin(F.col("url")), "_path": F.regexp_replace("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+", "")})
    open_ = files.where(F.col("status").isNotNull() & ~F.col("status").isin(*CLOSED)).select(F.col("origin").alias("_origin"))
    fits = rules.select(F.col("origin").alias("_origin"), "prefix", "allow")
    per_origin = fits.groupBy("_origin").agg(F.collect_list(F.struct(F.length("prefix").alias("n"), "allow", "prefix")).alias("_rules"))
    joined = named.join(open_, "_origin").join(per_origin, "_origin", "left")
    mine = F.filter(F.coalesce("_rules", F.array().cast("array<struct<n:int,allow:boolean,prefix:string>>")), lambda r: F.startswith(F.col("_path"), r["prefix"]))
    best = F.array_max(mine)
    return joined.where(F.coalesce(best["allow"], F.lit(True))).select(*pages.columns)
