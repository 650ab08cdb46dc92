"""Crawl planning and its log, over tables of pages instead of a live site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import slugify
from ..sources.shared import staged

GONE = (404, 410)


def label(location: Column, category: Column) -> Column:
    return F.concat_ws("/", location, F.coalesce(category, F.lit("all")))


def frontier(spark: SparkSession, location: str, categories: list[str]) -> DataFrame:
    """The whole district first, then each category of it: (ord, location, category, label)."""
    rows = [(0, location, None), *[(i + 1, location, c) for i, c in enumerate(categories)]]
    return spark.createDataFrame(rows, "ord int, location string, category string").withColumn("label", label(F.col("location"), F.col("category")))


def probe_grid(spark: SparkSession, slugs: list[str] | None = None) -> DataFrame:
    """Every district slug with every path template: a grid of two fixed lists."""
    templates = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(dims.PATH_TEMPLATES)], "template int, search string, category string")
    return dims.names(spark, slugs or dims.DISTRICT_SLUGS, "slug").crossJoin(templates)


#: Towns a query may be asked for again; the seeds are far fewer.
MOST_TOWNS = 10_000


def fan_out(saturated: DataFrame, towns: DataFrame, queued: DataFrame) -> DataFrame:
    """Saturated category queries town by town, without labels that are queued already. Every town is
    asked for, so the product is the result; up to ``MOST_TOWNS`` towns are broadcast, after a count."""
    slugs = towns.select(slugify(F.col("town")).alias("location"))
    few = slugs.limit(MOST_TOWNS + 1).count() <= MOST_TOWNS
    wide = saturated.where("category is not null").select("category").crossJoin(F.broadcast(slugs) if few else slugs)
    named = wide.withColumn("label", label(F.col("location"), F.col("category")))
    return named.join(queued.select("label"), "label", "left_anti").select("location", "category", "label")


def latest_pages(log: DataFrame, seq: str = "seq") -> DataFrame:
    """The page log, one row a URL: the latest visit, but the first visit's kind."""
    later = [c for c in log.columns if c not in ("url", "kind", seq)]
    grouped = log.groupBy("url").agg(F.min_by("kind", seq).alias("kind"), F.max_by(F.struct(*later), seq).alias("x"))
    return grouped.select("url", "kind", *[F.col(f"x.{c}").alias(c) for c in later])


def visited(pages: DataFrame) -> DataFrame:
    return pages.where("error is null and status < 400")


def unvisited(queue: DataFrame, pages: DataFrame, key: str = "url") -> DataFrame:
    """Anti-join: what a resumed run still has to do."""
    return queue.join(visited(pages).select(key), key, "left_anti")


def is_terminal(status: Column) -> Column:
    """Gone pages are never tried again."""
    return status.isin(*GONE)


def page_chain(pages: DataFrame, starts: DataFrame, cap: int = 25) -> DataFrame:
    """(start, page, url): recorded successors followed from each start, up to ``cap`` pages.

    One join a page, at most ``cap`` in all; each step is staged, so it is made once.
    """
    nexts = pages.select("url", F.col("next_url").alias("_next")).where("_next is not null")
    steps = [staged(starts.select(F.col("url").alias("start"), F.lit(1).alias("page"), "url"), "chain")]
    while len(steps) < cap and not steps[-1].isEmpty():
        step = steps[-1].join(nexts, "url").select("start", (F.col("page") + 1).alias("page"), F.col("_next").alias("url"))
        steps.append(staged(step, "chain"))
    return reduce(DataFrame.unionByName, steps)


def saturation(fetched: DataFrame, cap: int) -> DataFrame:
    """Per query: pages, listings, and whether it ran into the cap while still finding adverts."""
    return fetched.groupBy("label").agg(F.max("page").alias("pages"), F.sum("listings").alias("listings"), F.max_by("listings", "page").alias("last")).withColumn(
        "saturated", (F.col("pages") >= cap) & (F.col("last") > 0)
    ).drop("last")


def within_budget(fetched: DataFrame, budget: int, order: str = "seq") -> DataFrame:
    """Pages up to and including the one that reaches the budget of new listings.

    Pages are range-partitioned by their order, whatever its gaps; running sums are made in
    each partition, and only one sum a partition meets the others.
    """
    parts = staged(fetched.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("_part").agg(F.sum("new").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_ahead"))
    inside = F.coalesce(F.sum("new").over(Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = parts.withColumn("_in", inside).join(F.broadcast(ahead), "_part")  # as many rows as shuffle partitions
    return out.where(F.col("_in") + F.col("_ahead") < budget).select(*fetched.columns)


def tag(listings: DataFrame, category: Column, district: str = dims.DISTRICT) -> DataFrame:
    """Query category and district where a listing has none."""
    empty = F.lit("")
    return listings.withColumns({
        "category": F.coalesce(F.nullif("category", empty), category), "district": F.coalesce(F.nullif("district", empty), F.lit(district)),
    })


def crawl_summary(log: DataFrame) -> DataFrame:
    """Counters of a run and their one-line text."""
    one = log.agg(
        F.count_distinct("label").alias("queries"), F.count_if((F.col("kind") == "serp") & (F.col("status") < 400) & F.col("error").isNull()).alias("pages"),
        F.coalesce(F.sum("new"), F.lit(0)).alias("listings_new"), F.coalesce(F.sum("seen"), F.lit(0)).alias("listings_seen"),
        F.count_if((F.col("kind") == "detail") & (F.col("listings") > 0)).alias("details"),
        F.count_if((F.col("status") >= 400) | F.col("error").isNotNull()).alias("errors"),
    )
    text = F.format_string("%d queries, %d pages, %d new listings (%d seen), %d detail pages, %d errors", "queries", "pages", "listings_new", "listings_seen", "details", "errors")
    return one.withColumn("summary", text)


def progress_ticks(details: DataFrame, run: str, order: str, every: int = 25) -> DataFrame:
    """Every 25th row of a run and its last one."""
    w = Window.partitionBy(run)
    numbered = details.withColumns({"row": F.row_number().over(w.orderBy(order)), "total": F.count(F.lit(1)).over(w)})
    return numbered.where((F.col("row") % every == 0) | (F.col("row") == F.col("total")))


def start_run(spark: SparkSession, run_id: int, started_at: str, config: str, notes: str = "") -> DataFrame:
    return spark.createDataFrame([(run_id, started_at, None, config, notes)], "id long, started_at string, ended_at string, config string, notes string")


def end_run(runs: DataFrame, run_id: int, ended_at: str, notes: str) -> DataFrame:
    mine = F.col("id") == run_id
    return runs.withColumns({
        "ended_at": F.when(mine, ended_at).otherwise(F.col("ended_at")),
        "notes": F.when(mine, F.concat(F.coalesce("notes", F.lit("")), F.lit(notes))).otherwise(F.col("notes")),
    })
