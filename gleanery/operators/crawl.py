"""The crawl as set operations over a table of pages: search tiers, then detail pages.

All queries of a tier advance together, a join a page; a tier has at most as many joins as a
query may have pages, and there are two tiers. Pages are read once, before the first join.
What the run would have fetched is then put in the order of the queries, and cut at the page
that reaches the listing budget.

Defined edge cases
* a page that several queries reach is fetched by the first of them; the others follow its successor
* a page that isn't in the table is an error; an error or an empty page ends its query
* pages visited by an earlier run aren't fetched again; their recorded successors are followed
* empty tables give empty results and a summary of zeros
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import listing_id, search_url
from ..schemas import STORED_LISTING
from ..sources import pages as P
from ..sources.shared import staged
from . import choosing, frontier, merging

Progress = Callable[[str], None]
_ORDER = ["tier", "ord", "page"]


def _silent(message: str) -> None:
    return None


def read_site(site: DataFrame, settings: Mapping[str, Any], now: Column, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(facts, listings) of a table of pages (url, status, html). facts: url, status, listings,
    strategy, next_url; listings: the best strategy's, by page_url."""
    rows = staged(P.reads_and_next(site.where("status < 400"), settings["page_param"], settings["learned_selectors"]), "site")
    found = staged(choosing.best_reads(P.to_listings(rows.where(F.col("strategy") != P.NEXT), now, stamp)), "listings")
    counts = found.groupBy("page_url").agg(F.count(F.lit(1)).cast("int").alias("listings"), F.first("strategy").alias("strategy"))
    nexts = rows.where(F.col("strategy") == P.NEXT).select("page_url", F.col("url").alias("next_url"))
    told = nexts.join(counts, "page_url", "left").withColumnRenamed("page_url", "url")
    facts = site.dropDuplicates(["url"]).select("url", "status").join(told, "url", "left")
    return staged(facts.withColumn("listings", F.coalesce("listings", F.lit(0))), "facts"), found


def start_pages(queries: DataFrame, settings: Mapping[str, Any]) -> DataFrame:
    """(tier, ord, label, category, page, url): the first page of each query."""
    one = [F.lit(settings[k]) for k in ("base_url", "locale")]
    template = F.when(F.col("category").isNull(), settings["search_path_template"]).otherwise(settings["category_path_template"])
    first = search_url(one[0], template, one[1], F.col("location"), F.col("category"), F.lit(1), settings["page_param"])
    return queries.select("tier", "ord", "label", "category", F.lit(1).alias("page"), first.alias("url"))


def walk(starts: DataFrame, facts: DataFrame, log: DataFrame, cap: int) -> DataFrame:
    """Every page the queries come by: tier, ord, label, category, page, url, seen (by an earlier
    run), status (null: no such page), listings, strategy, next_url."""
    before = frontier.visited(log).select("url", F.col("next_url").alias("recorded"), F.lit(True).alias("seen"))
    steps, at = [], starts
    for _ in range(cap):
        hop = at.join(before, "url", "left").join(facts, "url", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
        goes_on = (F.col("status") < 400) & (F.col("listings") > 0)
        following = F.when(F.col("seen"), F.col("recorded")).when(goes_on, F.col("next_url"))
        step = staged(hop.withColumn("next_url", following).drop("recorded"), "hop")
        steps.append(step)
        at = step.where("next_url is not null").select("tier", "ord", "label", "category", (F.col("page") + 1).alias("page"), F.col("next_url").alias("url"))
        if at.isEmpty():
            break
    return reduce(DataFrame.unionByName, steps)


def fetched(walked: DataFrame) -> DataFrame:
    """The pages that a run fetches: each by the first query that comes by it, with seq, their order."""
    first = Window.partitionBy("url").orderBy(*_ORDER)
    own = walked.where("not seen").withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    # Tiers, queries and pages are few and numbered, so one number holds them in order.
    return own.withColumn("seq", (F.col("tier") * (1 << 40) + F.col("ord") * (1 << 20) + F.col("page")).cast("long"))


def count_new(own: DataFrame, found: DataFrame, stored: DataFrame) -> DataFrame:
    """``own`` with new and seen: a listing is new on the first page that shows it, if it isn't stored."""
    shown = own.select("seq", F.col("url").alias("page_url")).join(found.select("page_url", "listing_id"), "page_url")
    new = shown.groupBy("listing_id").agg(F.min("seq").alias("seq")).join(stored.select("listing_id"), "listing_id", "left_anti")
    counts = new.groupBy("seq").agg(F.count(F.lit(1)).alias("new"))
    rows = shown.groupBy("seq").agg(F.count(F.lit(1)).alias("rows"))
    out = own.join(rows, "seq", "left").join(counts, "seq", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("rows", "new")})
    return out.withColumn("seen_again", F.col("rows") - F.col("new")).drop("rows")


def crawl(site: DataFrame, stored: DataFrame, log: DataFrame, settings: Mapping[str, Any], now: Column, stamp: Column, progress: Progress = _silent):
    """(listings, log rows, summary): one run over ``site`` (url, status, html), with the listings
    ``stored`` and the page ``log`` of earlier runs. ``listings`` is the next snapshot."""
    spark, cap, budget = site.sparkSession, settings["max_pages_per_query"], settings["max_listings"]
    have = stored.count() if budget else 0
    facts, found = read_site(site, settings, now, stamp)

    def within(walked: DataFrame) -> DataFrame:
        counted = staged(count_new(fetched(walked), found, stored), "fetched")
        if not budget:
            return counted
        return staged(frontier.within_budget(counted, budget - have, "seq"), "budget") if budget > have else counted.limit(0)

    first = frontier.frontier(spark, settings["district_slug"], list(settings["categories"])).withColumn("tier", F.lit(0))
    walked = walk(start_pages(first, settings), facts, log, cap)
    own = within(walked)
    full = frontier.saturation(own, cap).where("saturated").select("label").join(first, "label")
    wide = frontier.fan_out(full.orderBy("ord"), spark.createDataFrame([(t,) for t in settings["towns"]], "town string"), first)
    second = wide.dropDuplicates(["label"]).withColumns({"tier": F.lit(1), "ord": F.row_number().over(Window.orderBy("category", "location"))})
    second = staged(second, "second")  # at most categories x towns, both fixed lists
    if not second.isEmpty():
        progress(f"fanning out to {second.count()} queries")
        own = within(walked.unionByName(walk(start_pages(second, settings), facts, log, cap)))

    ok = F.coalesce(F.col("status") < 400, F.lit(False))
    rows = own.select(
        "url", F.lit("serp").alias("kind"), F.coalesce("status", F.lit(0)).cast("int").alias("status"), F.when(ok, F.col("listings")).cast("int").alias("listings"),
        "strategy", "next_url", F.when(F.col("status").isNull(), "no such page").alias("error"), stamp.cast("string").alias("visited_at"),
        "label", "new", F.col("seen_again").alias("seen"), "seq",
    )
    shown = found.join(own.select(F.col("url").alias("page_url"), "seq", F.col("category").alias("_asked")), "page_url")
    tagged = frontier.tag(shown, F.col("_asked"), settings.get("district", frontier.dims.DISTRICT))
    counted = Observation("crawl")
    incoming = merging.complete(tagged, keep=["seq", "pos"]).withColumn("detail_fetched", F.lit(0)).observe(counted, F.count(F.lit(1)).alias("n"))
    # Adverts of a page follow each other; pages are numbered in steps of far more than a page has.
    incoming = staged(incoming.withColumn("seq", F.col("seq") * 10_000 + F.col("pos")).drop("pos"), "incoming")
    progress(f"{counted.get['n']} listings read")
    return merging.upsert(stored, incoming), rows, frontier.crawl_summary(rows)


def enrich(stored: DataFrame, site: DataFrame, settings: Mapping[str, Any], now: Column, stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(listings, log rows): pending listings joined with their detail pages. A page that could be
    fetched is done with, whatever was read off it, and so is one that is gone; others stay pending."""
    pending = stored.where("detail_fetched = 0").select("url").distinct()
    pages = site.dropDuplicates(["url"]).join(pending, "url", "left_semi")
    read = choosing.merge_details(P.to_listings(P.reads(pages.where("status < 400"), True, settings["learned_selectors"]), now, stamp))
    read = read.withColumns({"url": F.col("page_url"), "listing_id": listing_id(F.col("page_url")), "seq": F.lit(0).cast("long"), "detail_fetched": F.lit(1)})
    if not settings["collect_images"]:
        read = read.withColumn("image_urls", F.array().cast("array<string>"))
    read = staged(merging.complete(read, keep=["seq", "detail_fetched"]), "details")
    done = pages.where((F.col("status") < 400) | frontier.is_terminal(F.col("status"))).select("url")
    log = pages.select("url", "status").join(read.select("url", "extracted_by"), "url", "left").select(
        "url", F.lit("detail").alias("kind"), F.col("status").cast("int").alias("status"),
        F.when(F.col("status") < 400, F.col("extracted_by").isNotNull().cast("int")).alias("listings"), F.col("extracted_by").alias("strategy"),
    )
    return merging.mark_detail(merging.upsert(stored, read), done), log


def no_listings(spark) -> DataFrame:
    return spark.createDataFrame([], STORED_LISTING)
