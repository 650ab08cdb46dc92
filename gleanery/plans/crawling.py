"""Queries for crawl planning and its log."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dims
from ..functions.text import listing_id, page_number
from ..operators import crawl, discovery, frontier, merging, robots
from ..schemas import PAGES_LOG
from ..sources.config import Settings
from .reading import DETAIL, made
from .registry import query, table

_SLUGS = ", ".join(f"('{s}')" for s in dims.DISTRICT_SLUGS)


@query(f"""SELECT 'ratnapura' AS location, NULL AS category, 'ratnapura/all' AS label UNION ALL
SELECT 'ratnapura', category, 'ratnapura/' || category FROM (VALUES {", ".join(f"('{c}')" for c in dims.CATEGORIES)}) t(category)""")
def frontier_tier_one(spark, sf_dir):
    """SET-01, PRJ-04's labels."""
    return frontier.frontier(spark, dims.DISTRICT_SLUGS[0], dims.CATEGORIES).select("location", "category", "label")


@query(f"SELECT slug, template FROM (VALUES {_SLUGS}) t(slug), range(4) r(template)")
def probe_grid(spark, sf_dir):
    """JON-07."""
    return frontier.probe_grid(spark).select("slug", F.col("template").cast("long").alias("template"))


@query("""
WITH s AS (SELECT DISTINCT p_type AS category FROM part), t AS (SELECT trim(regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g'), '-') AS location FROM nation)
SELECT location, category, location || '/' || category AS label FROM s, t WHERE location <> 'nation-3'
""")
def cross_fanout(spark, sf_dir):
    """JON-09: saturated categories by town, less what is queued."""
    saturated = table(spark, sf_dir, "part").select(F.col("p_type").alias("category")).distinct()
    queued = saturated.select(F.concat(F.lit("nation-3/"), "category").alias("label"))
    return frontier.fan_out(saturated, table(spark, sf_dir, "nation").select(F.col("n_name").alias("town")), queued)


def _log(spark, sf_dir):
    """Events as a page log: url per user and kind, in the order of event_id."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), F.when(k % 2 == 0, "serp").otherwise("detail").alias("kind"),
        F.when(k % 7 == 0, 503).when(k % 11 == 0, 404).otherwise(200).alias("status"), (k % 5).cast("int").alias("listings"),
        F.when(k % 13 == 0, "broken").alias("error"), k.alias("seq"), F.col("event_type").alias("label"), (k % 3).alias("new"), (k % 4).alias("seen"),
    )


_LOG = """
WITH g AS (SELECT 'u' || user_id AS url, CASE WHEN event_id % 2 = 0 THEN 'serp' ELSE 'detail' END AS kind,
  CASE WHEN event_id % 7 = 0 THEN 503 WHEN event_id % 11 = 0 THEN 404 ELSE 200 END AS status, (event_id % 5)::INT AS listings, CASE WHEN event_id % 13 = 0 THEN 'broken' END AS error,
  event_id AS seq, event_type AS label, event_id % 3 AS new, event_id % 4 AS seen FROM events),
p AS (SELECT url, arg_min(kind, seq) AS kind, arg_max(status, seq) AS status, arg_max(listings, seq) AS listings, arg_max({'e': error}, seq).e AS error FROM g GROUP BY url)
"""


@query(_LOG + "SELECT url, kind, status, listings, error FROM p")
def page_log_latest(spark, sf_dir):
    """SNK-07."""
    return frontier.latest_pages(_log(spark, sf_dir).drop("label", "new", "seen"))


@query(_LOG + "SELECT url FROM p WHERE error IS NULL AND status < 400")
def visited_pages(spark, sf_dir):
    """FLT-03."""
    return frontier.visited(frontier.latest_pages(_log(spark, sf_dir))).select("url")


@query(_LOG + "SELECT 'u' || c_custkey AS url FROM customer WHERE 'u' || c_custkey NOT IN (SELECT url FROM p WHERE error IS NULL AND status < 400)")
def anti_resume(spark, sf_dir):
    """JON-08."""
    queue = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"))
    return frontier.unvisited(queue, frontier.latest_pages(_log(spark, sf_dir)))


@query(_LOG + "SELECT url, status IN (404, 410) AS gone FROM p")
def terminal_pages(spark, sf_dir):
    """STM-05."""
    return frontier.latest_pages(_log(spark, sf_dir)).select("url", frontier.is_terminal(F.col("status")).alias("gone"))


@query("SELECT c_custkey AS label FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def set_diff(spark, sf_dir):
    """SET-02."""
    queued = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("label"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("label")).join(queued, "label", "left_anti")


@query("""
WITH RECURSIVE s AS (SELECT event_id, user_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
c(start, page, url) AS (SELECT event_id, 1, event_id FROM s WHERE k = 1 UNION ALL SELECT c.start, c.page + 1, s.nxt FROM c JOIN s ON s.event_id = c.url WHERE s.nxt IS NOT NULL AND c.page < 5)
SELECT start::VARCHAR AS start, page, url::VARCHAR AS url FROM c
""")
def page_chain(spark, sf_dir):
    """JON-10, LIM-02: recorded successors, followed to the page cap."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    e = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("url"), F.lead("event_id").over(w).cast("string").alias("next_url"), F.row_number().over(w).alias("k")
    )
    return frontier.page_chain(e, e.where("k = 1"), 5)


_FETCHED = "WITH f AS (SELECT 'q' || user_id AS label, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page, event_id % 4 AS listings FROM events)"


@query(_FETCHED + " SELECT label, max(page) AS pages, sum(listings)::BIGINT AS listings, max(page) >= 8 AND arg_max(listings, page) > 0 AS saturated FROM f GROUP BY label")
def saturated_queries(spark, sf_dir):
    """WIN-11."""
    from pyspark.sql import Window

    page = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    f = table(spark, sf_dir, "events").select(F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("label"), page.cast("long").alias("page"), (F.col("event_id") % 4).alias("listings"))
    return frontier.saturation(f, 8)


@query("SELECT event_id, new FROM (SELECT event_id, event_id % 3 AS new, coalesce(sum(event_id % 3) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) WHERE before < 5000")
def listing_budget(spark, sf_dir):
    """LIM-01: pages are read until the budget of new listings is reached."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 3).alias("new"))
    return frontier.within_budget(e, 5000, "event_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'query' WHEN c_custkey % 3 = 1 THEN 'query' ELSE c_mktsegment END AS category, CASE WHEN c_custkey % 2 = 0 THEN 'Ratnapura' ELSE 'Kandy' END AS district FROM customer")
def tag_fallback(spark, sf_dir):
    """PRJ-04."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(k % 3 == 0, None).when(k % 3 == 1, "").otherwise(F.col("c_mktsegment")).alias("category"), F.when(k % 2 == 1, "Kandy").alias("district"))
    return frontier.tag(rows, F.lit("query"))


@query(_LOG + """, c AS (SELECT count(DISTINCT label) AS queries, count(*) FILTER (kind = 'serp' AND status < 400 AND error IS NULL) AS pages, sum(new)::BIGINT AS listings_new, sum(seen)::BIGINT AS listings_seen,
count(*) FILTER (kind = 'detail' AND listings > 0) AS details, count(*) FILTER (status >= 400 OR error IS NOT NULL) AS errors FROM g)
SELECT *, queries || ' queries, ' || pages || ' pages, ' || listings_new || ' new listings (' || listings_seen || ' seen), ' || details || ' detail pages, ' || errors || ' errors' AS summary FROM c""")
def crawl_summary(spark, sf_dir):
    """AGG-14."""
    return frontier.crawl_summary(_log(spark, sf_dir))


@query("SELECT user_id, event_id, row, total FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS row, count(*) OVER (PARTITION BY user_id) AS total FROM events) WHERE row % 25 = 0 OR row = total")
def progress_ticks(spark, sf_dir):
    """WIN-09."""
    return frontier.progress_ticks(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id").withColumn("row", F.col("row").cast("long"))


@query("SELECT 2::BIGINT AS id, 't0' AS started_at, 't9' AS ended_at, 'a; done' AS notes UNION ALL SELECT 1, 't0', NULL, NULL")
def run_log(spark, sf_dir):
    """SNK-08."""
    runs = frontier.start_run(spark, 1, "t0", "{}", None).unionByName(frontier.start_run(spark, 2, "t0", "{}", "a; "))
    return frontier.end_run(runs, 2, "t9", "done").select("id", "started_at", "ended_at", "notes")


@query("SELECT p_partkey AS ord, 'u' || p_partkey AS url, p_size AS listings FROM part WHERE p_partkey % 3 <> 0 AND p_size > 0 ORDER BY p_size DESC, p_partkey LIMIT 1")
def best_probe(spark, sf_dir):
    """WIN-08."""
    k = F.col("p_partkey")
    probes = table(spark, sf_dir, "part").select(k.alias("ord"), F.concat(F.lit("u"), k.cast("string")).alias("url"), F.when(k % 3 == 0, 404).otherwise(200).alias("status"), F.col("p_size").alias("listings"))
    return discovery.best_probe(probes).select("ord", "url", "listings")


@query("""
SELECT page_id, url FROM pages WHERE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) NOT LIKE '%.net'
AND NOT (contains(url, '/de/') AND NOT regexp_matches(url, '^[^/]+//[^/]+/de/5'))
""")
def robots_filter(spark, sf_dir):
    """SRC-03: the longest rule of an origin decides; sites without a readable file are closed."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    origins = pages.select(robots.origin(F.col("url")).alias("origin")).distinct()
    files = origins.withColumn("status", F.when(F.endswith("origin", F.lit(".net")), 403).otherwise(200))
    rule = F.explode(F.array(F.struct(F.lit("/de/").alias("prefix"), F.lit(False).alias("allow")), F.struct(F.lit("/de/5").alias("prefix"), F.lit(True).alias("allow")))).alias("r")
    return robots.allowed(pages, origins.select("origin", rule).select("origin", "r.prefix", "r.allow"), files)


@query("""
SELECT sha1(url) AS cache_key, arg_max(page_id, page_id) AS page_id, 200 AS status, true AS from_cache FROM pages WHERE page_id % 3 <> 0 GROUP BY url
""")
def page_cache(spark, sf_dir):
    """SRC-02: successes only, one entry a URL, found by the URL's hash."""
    rows = table(spark, sf_dir, "pages").withColumn("status", F.when(F.col("page_id") % 3 == 0, 503).otherwise(200))
    ok = rows.where("status < 400").groupBy("url").agg(F.max("page_id").alias("page_id"))
    return ok.select(F.sha1("url").alias("cache_key"), "page_id", F.lit(200).alias("status"), F.lit(True).alias("from_cache"))


_SITE = "https://x.example/en/ads/"
_NOW = "2026-07-01 12:00:00"
_TOWN_SLUGS = sorted({t.lower().replace(" ", "-") for t in dims.TOWNS} - {"ratnapura"})
#: (location, category, pages) of a small site; a page shows the nations whose key leaves page - 1 by 3.
_ASKED = [("ratnapura", None, 1), ("ratnapura", "vehicles", 4), ("ratnapura", "property", 2), *[(t, "vehicles", 2) for t in _TOWN_SLUGS]]


def _site(spark, sf_dir):
    """(url, status, html) of result pages, every page's adverts made of ``nation``."""
    asked = spark.createDataFrame(_ASKED, "location string, category string, pages int").withColumn("page", F.explode(F.expr("sequence(1, pages)")))
    label = F.concat_ws("-", "location", F.coalesce("category", F.lit("all")))
    link = F.concat(F.lit("<div><p><a href='/en/ad/"), label, F.lit("-"), F.col("n_nationkey").cast("string"), F.lit("'>An advert of "), F.col("n_name"), F.lit("</a></p></div>"))
    shown = asked.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") % 3 == F.col("page") - 1, "left")
    bodies = shown.groupBy("location", "category", "pages", "page").agg(F.array_join(F.collect_list(link), "").alias("body"))
    first = F.concat(F.lit(_SITE), F.concat_ws("/", "location", "category"))
    url = F.when(F.col("page") > 1, F.concat(first, F.lit("?page="), F.col("page").cast("string"))).otherwise(first)
    following = F.when(F.col("page") < F.col("pages"), F.concat(F.lit("<a href='?page="), (F.col("page") + 1).cast("string"), F.lit("'>more</a>"))).otherwise(F.lit(""))
    return bodies.select(url.alias("url"), F.lit(200).alias("status"), F.concat(F.lit("<html><body>"), "body", following, F.lit("</body></html>")).alias("html"))


def _settings(**more):
    return Settings(base_url="https://x.example", categories=["vehicles", "property"], **more)


_TOWN_ROWS = ", ".join(f"('{t}', 'vehicles', 2)" for t in _TOWN_SLUGS)


@query(f"""
WITH q AS (SELECT * FROM (VALUES ('ratnapura', NULL, 1), ('ratnapura', 'vehicles', 4), ('ratnapura', 'property', 2), {_TOWN_ROWS}) t(l, c, n)),
p AS (SELECT l || '/' || coalesce(c, 'all') AS label, unnest(range(1, least(n, 3) + 1))::INT AS page FROM q)
SELECT label, page, count(*)::INT AS listings, count(*) AS new FROM p JOIN nation ON n_nationkey % 3 = page - 1 GROUP BY label, page
""")
def crawl_fan_out(spark, sf_dir):
    """STM-04, UDF-05: a query that runs to the page cap while it finds adverts is asked again town by town."""
    _, log, _ = crawl.crawl(_site(spark, sf_dir), crawl.no_listings(spark), spark.createDataFrame([], PAGES_LOG), _settings(max_pages_per_query=3), F.lit(_NOW).cast("timestamp"), F.lit("t"))
    return log.withColumn("page", page_number(F.col("url"))).select("label", "page", "listings", "new")


@query("""
WITH p(label, page) AS (VALUES ('ratnapura/vehicles', 3), ('ratnapura/property', 2))
SELECT label, page::INT AS page, count(*)::INT AS listings, count(*) FILTER (label = 'ratnapura/property' OR n_nationkey % 2 = 1) AS new FROM p JOIN nation ON n_nationkey % 3 = page - 1 GROUP BY label, page
UNION ALL SELECT 'ratnapura/vehicles', 4, 0, 0
""")
def crawl_resume(spark, sf_dir):
    """STM-01: visited pages are skipped by their recorded successors; a failed visit is made again."""
    base = f"{_SITE}ratnapura"
    visits = [
        (base, 200, None), (f"{base}/vehicles", 200, f"{base}/vehicles?page=2"), (f"{base}/vehicles?page=2", 200, f"{base}/vehicles?page=3"),
        (f"{base}/vehicles?page=3", 503, None), (f"{base}/property", 200, f"{base}/property?page=2"),
    ]
    log = spark.createDataFrame([(u, "serp", s, 9, "x", n, None, "t") for u, s, n in visits], PAGES_LOG)
    known = table(spark, sf_dir, "nation").where("n_nationkey % 6 = 2").select(F.concat(F.lit("/en/ad/ratnapura-vehicles-"), F.col("n_nationkey").cast("string")).alias("url"))
    stored = merging.complete(known.withColumn("listing_id", listing_id(F.col("url")))).withColumn("detail_fetched", F.lit(0))
    _, rows, _ = crawl.crawl(_site(spark, sf_dir), stored, log, _settings(), F.lit(_NOW).cast("timestamp"), F.lit("t"))
    return rows.withColumn("page", page_number(F.col("url"))).select("label", "page", "listings", "new")


@query("""
SELECT sum(n) >= 12 AS reached, sum(n) - max(last) < 12 AS not_before, count(*) AS pages FROM (
SELECT page, count(*) AS n, count(*) AS last FROM (VALUES (1), (2)) t(page) JOIN nation ON n_nationkey % 3 = page - 1 GROUP BY page)
""")
def crawl_budget(spark, sf_dir):
    """LIM-01: the run ends at the page that reaches the budget, here the second: the first query has one page."""
    listings, log, _ = crawl.crawl(_site(spark, sf_dir), crawl.no_listings(spark), spark.createDataFrame([], PAGES_LOG), _settings(max_listings=12), F.lit(_NOW).cast("timestamp"), F.lit("t"))
    last = log.agg(F.max_by("new", "seq").alias("last"), F.count(F.lit(1)).alias("pages"))
    return listings.agg(F.count(F.lit(1)).alias("n")).crossJoin(last).select((F.col("n") >= 12).alias("reached"), (F.col("n") - F.col("last") < 12).alias("not_before"), "pages")


@query("""
WITH p AS (SELECT p_partkey AS k, p_name AS name, floor(p_retailprice)::BIGINT AS price FROM part)
SELECT 'https://x.example/en/ad/p-' || k AS url, CASE WHEN k % 3 = 0 THEN name ELSE 'card title' END AS title, CASE WHEN k % 3 = 0 THEN price::DOUBLE END AS price_value,
  CASE WHEN k % 3 = 0 THEN 'Embilipitiya' ELSE 'Pelmadulla' END AS town, '2 days ago' AS posted_text, CASE WHEN k % 3 = 0 THEN 'Text of ' || k END AS description,
  CASE WHEN k % 3 = 0 THEN 2 ELSE 0 END AS images, CASE WHEN k % 3 = 2 THEN 0 ELSE 1 END AS detail_fetched FROM p
""")
def detail_enrichment(spark, sf_dir):
    """JON-12, SNK-09, STM-05: cards meet their detail pages; what the card knew stays, gone adverts are done with, failures stay pending."""
    pages = made(spark, sf_dir, DETAIL).withColumn("k", page_number(F.col("url"))).withColumn("url", F.concat(F.lit("https://x.example/en/ad/p-"), F.col("k").cast("string")))
    k = F.col("k")
    cards = pages.select("url", F.lit("card title").alias("title"), F.lit("Pelmadulla").alias("town"), F.lit("2 days ago").alias("posted_text"))
    stored = merging.complete(cards.withColumn("listing_id", listing_id(F.col("url")))).withColumn("detail_fetched", F.lit(0))
    site = pages.withColumn("status", F.when(k % 3 == 0, 200).when(k % 3 == 1, 410).otherwise(503)).where(k % 6 != 5)
    out, _ = crawl.enrich(stored, site, _settings(), F.lit(_NOW).cast("timestamp"), F.lit("t"))
    return out.select("url", "title", "price_value", "town", "posted_text", "description", F.size(F.coalesce("image_urls", F.array().cast("array<string>"))).alias("images"), "detail_fetched")
