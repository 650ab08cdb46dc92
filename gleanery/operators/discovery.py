"""What a first look at a site's pages tells: selectors, categories, strategies, payloads."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.text import stable_class
from ..sources import pages as P
from ..sources.shared import staged

TOP_CLASSES = 8
TOP_SLUGS = 60
TOP_KEYS = 40
SAMPLES = 3


def learn_cards(pages: DataFrame, top: int = TOP_CLASSES) -> DataFrame:
    """(selector, raw_class, matches): the classes most often around advert links; ties by first sight."""
    return _cards(P.ancestors(pages), top)


def _cards(seen: DataFrame, top: int = TOP_CLASSES) -> DataFrame:
    seen = seen.groupBy("tag", "class").agg(F.count(F.lit(1)).alias("matches"), F.min(F.struct("page_url", "pos")).alias("_first"))
    best = seen.orderBy(F.desc("matches"), "_first").limit(top)
    selector = F.concat(F.col("tag"), F.lit("[class*='"), stable_class(F.col("class")), F.lit("']"))
    return best.select(selector.alias("selector"), F.col("class").alias("raw_class"), "matches")


def category_slugs(hrefs: DataFrame, locale: str = "en", top: int = TOP_SLUGS) -> DataFrame:
    """(slug, n) of category links; ties by first sight. ``hrefs``: page_url, pos, href."""
    path = F.regexp_replace(F.substring_index(F.substring_index("href", "#", 1), "?", 1), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    slug = F.regexp_extract(path, rf"^/{re.escape(locale)}/ads/(?:[a-z0-9-]+/)?([a-z0-9-]+)/?$", 1)
    named = hrefs.withColumn("slug", slug).where((F.col("slug") != "") & ~F.col("slug").isin(*dims.DISTRICT_SLUGS, "ads", locale))
    counted = named.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("page_url", "pos")).alias("_first"))
    return counted.orderBy(F.desc("n"), "_first").limit(top).select("slug", "n")


def categories(hrefs: DataFrame, locale: str = "en") -> list[str]:
    """Discovered slugs (at most ``TOP_SLUGS``), else the seeds."""
    return [r["slug"] for r in category_slugs(hrefs, locale).collect()] or dims.CATEGORIES


def payloads(pages: DataFrame, top: int = TOP_KEYS) -> DataFrame:
    """(page_url, blob_count, top_level_keys) of hydration payloads; the first keys only, as a preview."""
    found = [F.regexp_extract_all("html", F.lit("(?s)" + p), F.lit(1)) for p in P.STATE_PATTERNS]
    blobs = F.filter(F.concat(*found), lambda b: F.json_object_keys(b).isNotNull())
    keys = F.slice(F.flatten(F.transform(blobs, F.json_object_keys)), 1, top)
    return pages.select(F.col("url").alias("page_url"), F.size(blobs).alias("blob_count"), keys.alias("top_level_keys"))


def best_probe(probes: DataFrame) -> DataFrame:
    """The attempt that answered with most listings; ties: the first tried. ``probes``: ord, url, status, listings, ..."""
    ok = probes.where("status = 200 and listings > 0")
    return ok.orderBy(F.desc("listings"), "ord").limit(1)


def samples(reads: DataFrame, n: int = SAMPLES) -> DataFrame:
    return reads.where(F.col("pos") < n).select("page_url", "url", "title", "price_text", "location_text", "posted_text")


def report(pages: DataFrame, locale: str = "en") -> dict:
    """What a first look tells, as one object: strategies, card candidates, categories, payloads. Each
    part is bounded, whatever the pages, which are parsed once."""
    seen = staged(P.first_look(pages), "look")
    counts = seen.where("strategy is not null").groupBy("strategy").agg(F.count(F.lit(1)).alias("n")).collect()
    return {
        "strategies": {r["strategy"]: r["n"] for r in counts},
        "card_candidates": [r.asDict() for r in _cards(seen.where("tag is not null")).collect()],
        "categories": categories(seen.where("href is not null").select("page_url", "pos", "href"), locale),
        "payloads": [r.asDict() for r in payloads(pages).where("blob_count > 0").limit(SAMPLES).collect()],
    }
