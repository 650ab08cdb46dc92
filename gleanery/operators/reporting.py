"""Reports over stored listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims


def labelled(c: Column, label: str = dims.UNKNOWN) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(label))


def totals(listings: DataFrame) -> DataFrame:
    """One pass: listings, with_detail, with_price."""
    return listings.agg(
        F.count(F.lit(1)).alias("listings"), F.count_if(F.col("detail_fetched") == 1).alias("with_detail"), F.count("price_value").alias("with_price")
    )


def counts_by(rows: DataFrame, column: str, top: int | None = None, label: str = dims.UNKNOWN) -> DataFrame:
    """(key, n), most first, then by key; the ``top`` first where given."""
    out = rows.groupBy(labelled(F.col(column), label).alias("key")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "key")
    return out.limit(top) if top else out


def stats(listings: DataFrame, pages: DataFrame, top_categories: int = 25) -> DataFrame:
    """(section, key, n) of the whole report."""
    one = totals(listings).crossJoin(pages.agg(F.count(F.lit(1)).alias("pages_visited")))  # one row each
    names = ["listings", "with_detail", "with_price", "pages_visited"]
    rows = F.array(*[F.struct(F.lit("total").alias("section"), F.lit(n).alias("key"), F.col(n).alias("n")) for n in names])
    out = one.select(F.explode(rows).alias("x")).select("x.*")
    for section, column, top in (("town", "town", None), ("category", "category", top_categories), ("strategy", "extracted_by", None)):
        out = out.unionByName(counts_by(listings, column, top).select(F.lit(section).alias("section"), "key", "n"))
    return out


def mean_price_by_town(listings: DataFrame) -> DataFrame:
    """Adverts and rounded mean price by town and category where a price is known, dearest first."""
    listings.createOrReplaceTempView("_listings")
    return listings.sparkSession.sql(
        "SELECT town, category, count(*) AS n, round(avg(price_value)) AS mean_price FROM _listings "
        "WHERE price_value > 0 GROUP BY town, category ORDER BY 3 DESC, 1, 2"
    )


def pending_details(listings: DataFrame, limit: int | None = None) -> DataFrame:
    """URLs whose detail page hasn't been read, oldest first."""
    out = listings.where("detail_fetched = 0").orderBy("scraped_at", "url").select("url")
    return out.limit(limit) if limit else out


def scan(listings: DataFrame, district: str | None = None) -> DataFrame:
    out = listings.where(F.col("district") == district) if district else listings
    return out.orderBy("listing_id")


def lookup(listings: DataFrame, url: str) -> DataFrame:
    return listings.where(F.col("url") == url).limit(1)
