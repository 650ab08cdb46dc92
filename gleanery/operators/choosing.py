"""First-wins dedup and choosing the best of several reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RAW_READ
from ..sources.shared import staged
from .merging import fold

_FILLED = ("title", "price_text", "location_text", "posted_text")
_DETAIL = ("title", "description", "price_text", "location_text", "posted_text")


def first_by(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_at = 1").drop("_at")


def filled(columns) -> Column:
    return sum((F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in columns), F.lit(0))


def strategy_scores(reads: DataFrame, page: str = "page_url") -> DataFrame:
    """Per page and strategy: rows and mean number of filled fields."""
    return reads.groupBy(page, "strategy", "strategy_ord").agg(F.count(F.lit(1)).alias("n"), F.avg(filled(_FILLED)).alias("fill"))


def best_strategy(scores: DataFrame, page: str = "page_url") -> DataFrame:
    """Most rows, then the fullest, then the strategy that comes first."""
    rank = F.struct("n", "fill", (-F.col("strategy_ord")).alias("o"))
    return scores.groupBy(page).agg(F.max_by("strategy", rank).alias("strategy"), F.max("n").alias("listings"))


def best_reads(reads: DataFrame, page: str = "page_url") -> DataFrame:
    """The reads of each page's best strategy. One shuffle by page; pages are read once."""
    own, whole = Window.partitionBy(page, "strategy", "strategy_ord"), Window.partitionBy(page)
    rank = F.struct(F.count(F.lit(1)).over(own), F.avg(filled(_FILLED)).over(own), -F.col("strategy_ord"))
    ranked = reads.repartition(F.col(page)).withColumn("_rank", rank)
    return ranked.withColumn("_best", F.max("_rank").over(whole)).where("_rank = _best").drop("_rank", "_best")


def detail_score() -> Column:
    return filled(_DETAIL) + F.size(F.coalesce("attributes", F.create_map().cast("map<string,string>"))) * 0.1 + F.size(F.coalesce("image_urls", F.array().cast("array<string>"))) * 0.05


def merge_details(reads: DataFrame, page: str = "page_url") -> DataFrame:
    """One listing a detail page: the richest read first, each poorer one laid over it. Pages are read
    once; the fold reads its observations three times."""
    ranked = reads.withColumn("seq", F.row_number().over(Window.partitionBy(page).orderBy(F.desc(detail_score()), "strategy_ord")))
    return fold(staged(ranked, "details"), key=page)


def strategy_counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy("strategy").agg(F.count(F.lit(1)).alias("n"))


RAW_COLUMNS = [f.name for f in RAW_READ.fields]
