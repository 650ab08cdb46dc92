"""Queries for reading pages. Adverts are written into pages made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import choosing, discovery
from ..sources import pages as P
from .registry import query, table

def made(spark, sf_dir, template, n_columns=("k", "name", "price")):
    """(url, html) per part: ``template`` with its own key, name and price."""
    part = table(spark, sf_dir, "part")
    values = {"k": F.col("p_partkey").cast("string"), "name": F.col("p_name"), "price": F.floor("p_retailprice").cast("string")}
    html = F.lit(template)
    for name in n_columns:
        html = F.replace(html, F.lit(f"<<{name}>>"), values[name])
    return part.select(F.concat(F.lit("https://x.example/en/ads/p?page="), values["k"]).alias("url"), html.alias("html"))


_LD = """<html><head><link rel="next" href="/en/ads/p?page=2"/><script type="application/ld+json">{"@type":"ItemList","items":[
{"@type":"Product","url":"/en/ad/a-<<k>>","name":" <<name>>  x","offers":{"price":"<<price>>","priceCurrency":"LKR"},"areaServed":{"name":"Balangoda, Ratnapura"},"image":["i.jpg"]},
{"@type":["Thing","Vehicle"],"@id":"https://x.example/en/ad/b-<<k>>","name":"second"},{"@type":"Product","url":"/en/other/c"}]}</script></head><body></body></html>"""

STATE = """<html><script>window.__INITIAL_STATE__ = {"ads":[{"slug":"s-<<k>>","title":"<<name>>","price":<<price>>,"location":{"name":"Kuruwita"},"timeStamp":"2 days ago","mileage":12,"isFeatured":true},
{"url":"/en/ad/t-<<k>>","title":"two","price":{"amount":7,"currency":"Rs"}}]};</script></html>"""

CARDS = """<html><body><ul><li class="ad-card--x9y8z"><h2><<name>></h2><a href="/en/ad/c-<<k>>?q=1"><img src="/i/1.png"></a><div class="price">Rs <<price>></div>
<div class="description">Pelmadulla, Ratnapura</div><div class="updated-time">yesterday</div><span class="top-ad">!</span></li>
<li class="ad-card--x9y8z"><a href="/en/ad/d-<<k>>" title="from link"></a></li><li class="nav"><a href="/en/ads/all">all</a></li></ul></body></html>"""

_LINKS = """<html><body><div><div><p><a href="/en/ad/e-<<k>>"><<name>> sale</a></p><p>Rs <<price>></p><p>in Balangoda</p><p>3 days ago</p></div>
<div><a href="/en/ad/f-<<k>>"><img data-src="/x.png"></a><span>a very long name here</span></div></div></body></html>"""

DETAIL = """<html><body><nav class="breadcrumb"><a>Home</a><a>Property</a><a>Land</a></nav><h1><<name>></h1><div class="price">Rs <<price>> Negotiable</div><div class="location">Embilipitiya, Ratnapura</div>
<dl><dt>Condition:</dt><dd>Used</dd><dt>Size:</dt><dd><<k>> perches</dd></dl><div class="detail-item"><b>Size</b><span>ignored</span></div><div class="detail-item"><b>Road:</b><span>wide</span></div>
<div class="description">Text of <<k>></div><div class="gallery"><img src="/g/1.jpg"><img src="/g/1.jpg"><img src="/g/2.jpg"></div></body></html>"""


def _results(spark, sf_dir, template):
    found = P.reads(made(spark, sf_dir, template))
    rows = choosing.best_reads(P.to_listings(found, F.lit("2026-07-01 12:00:00").cast("timestamp"), F.lit("t")))
    return rows.select("strategy", "url", "title", "price_text", "price_value", "currency", "town", "district", "posted_at", "is_promoted", F.size("image_urls").alias("images"))


def _sql(*rows: str) -> str:
    return "WITH p AS (SELECT p_partkey::VARCHAR AS k, p_name AS name, floor(p_retailprice)::BIGINT AS price FROM part)\n" + "\nUNION ALL ".join(
        f"SELECT {r} FROM p" for r in rows
    )


_NO_DATE = "NULL::VARCHAR AS posted_at"


@query(_sql(
    "'json-ld' AS strategy, 'https://x.example/en/ad/a-' || k AS url, name || ' x' AS title, 'LKR ' || price AS price_text, price::DOUBLE AS price_value, 'LKR' AS currency, 'Balangoda' AS town, 'Ratnapura' AS district, " + _NO_DATE + ", false AS is_promoted, 1 AS images",
    "'json-ld', 'https://x.example/en/ad/b-' || k, 'second', NULL, NULL, NULL, NULL, NULL, NULL, false, 0",
))
def read_linked_data(spark, sf_dir):
    """SRC-11, JSN-02, JSN-03, FLT-07, STR-06, UDF-01, UDF-02."""
    return _results(spark, sf_dir, _LD)


@query(_sql(
    "'state-blob' AS strategy, 'https://x.example/en/ad/s-' || k AS url, name AS title, 'Rs ' || format('{:,}', price) AS price_text, price::DOUBLE AS price_value, 'LKR' AS currency, 'Kuruwita' AS town, NULL::VARCHAR AS district, '2026-06-29T12:00:00+00:00' AS posted_at, true AS is_promoted, 0 AS images",
    "'state-blob', 'https://x.example/en/ad/t-' || k, 'two', 'Rs 7', 7.0, 'LKR', NULL, NULL, NULL, false, 0",
))
def read_state(spark, sf_dir):
    """SRC-12, JSN-04, FLT-10, FLT-11."""
    return _results(spark, sf_dir, STATE)


@query(_sql(
    "'selectors' AS strategy, 'https://x.example/en/ad/c-' || k || '?q=1' AS url, name AS title, 'Rs ' || price AS price_text, price::DOUBLE AS price_value, 'LKR' AS currency, 'Pelmadulla' AS town, 'Ratnapura' AS district, '2026-06-30T00:00:00+00:00' AS posted_at, true AS is_promoted, 1 AS images",
    "'selectors', 'https://x.example/en/ad/d-' || k, 'from link', NULL, NULL, NULL, NULL, NULL, NULL, false, 0",
))
def read_cards(spark, sf_dir):
    """HTM-01, FLT-08, WIN-07."""
    return _results(spark, sf_dir, CARDS)


@query(_sql(
    "'link-heuristic' AS strategy, 'https://x.example/en/ad/e-' || k AS url, name || ' sale' AS title, 'Rs ' || price AS price_text, price::DOUBLE AS price_value, 'LKR' AS currency, 'in Balangoda' AS town, NULL::VARCHAR AS district, '2026-06-28T12:00:00+00:00' AS posted_at, false AS is_promoted, 0 AS images",
    "'link-heuristic', 'https://x.example/en/ad/f-' || k, 'a very long name here', NULL, NULL, NULL, NULL, NULL, NULL, false, 1",
))
def html_card_climb(spark, sf_dir):
    """HTM-02, FLT-14, ARR-01."""
    return _results(spark, sf_dir, _LINKS)


@query(_sql(
    "name AS title, price::DOUBLE AS price_value, 'Negotiable' AS price_qualifier, 'Property' AS category, 'Land' AS subcategory, 'Used' AS condition, 'Embilipitiya' AS town, 'Text of ' || k AS description, '\"' || k || ' perches\"' AS size_attr, '\"wide\"' AS road_attr, 2 AS images",
))
def read_detail(spark, sf_dir):
    """HTM-03, JON-11, MAP-02, WIN-05, FLT-09, SET-04."""
    found = P.reads(made(spark, sf_dir, DETAIL), detail=True)
    merged = choosing.merge_details(P.to_listings(found, F.lit("2026-07-01 12:00:00").cast("timestamp"), F.lit("t")))
    return merged.select(
        "title", "price_value", "price_qualifier", "category", "subcategory", "condition", "town", "description",
        F.try_element_at("attributes", F.lit("Size")).alias("size_attr"), F.try_element_at("attributes", F.lit("Road")).alias("road_attr"), F.size("image_urls").alias("images"),
    )


_BOTH = _LD.replace("</head>", "<script>window.__data = {\"x\": {\"title\": \"state title\", \"url\": \"/en/ad/a-<<k>>\", \"details\": \"body\", \"size\": 3}}</script></head>")


@query(_sql("'https://x.example/en/ad/a-' || k AS url, 'state-blob' AS extracted_by, 'state title' AS title, 'body' AS description, 'Balangoda' AS town, '3' AS size_attr"))
def merge_detail_reads(spark, sf_dir):
    """WIN-05, WIN-06: the poorer read is laid over the richer one, so its known values win."""
    found = P.reads(made(spark, sf_dir, _BOTH), detail=True)
    merged = choosing.merge_details(P.to_listings(found, F.lit("2026-07-01 12:00:00").cast("timestamp"), F.lit("t")))
    return merged.select("url", "extracted_by", "title", "description", "town", F.try_element_at("attributes", F.lit("size")).alias("size_attr"))


@query(_sql("'https://x.example/en/ads/p?page=' || k AS page_url, 'https://x.example/en/ads/p?page=2' AS next_url"))
def next_page_links(spark, sf_dir):
    """STR-12."""
    return P.next_pages(made(spark, sf_dir, _LD))


@query("SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href=')) AS n FROM pages")
def html_links(spark, sf_dir):
    """HTM-01: anchors of raw pages."""
    pages = table(spark, sf_dir, "pages").select(F.concat_ws("#", F.col("page_id").cast("string"), "url").alias("url"), "html")
    counted = P.links(pages).groupBy("page_url").agg(F.count(F.lit(1)).alias("n"))
    every = pages.select(F.col("url").alias("page_url")).join(counted, "page_url", "left")
    return every.select(F.substring_index("page_url", "#", 1).cast("long").alias("page_id"), F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT event_id, 0 AS pos, array_to_string(json_keys(props), ',') AS keys FROM events")
def json_walk(spark, sf_dir):
    """JSN-02."""
    return P.json_objects(table(spark, sf_dir, "events"), "props", "event_id").select("event_id", "pos", F.array_join("keys", ",").alias("keys"))


@query(_sql("'https://x.example/en/ads/p?page=' || k AS page_url, 1 AS blob_count, 'ads' AS keys"))
def state_payloads(spark, sf_dir):
    """AGG-16, LIM-03."""
    return discovery.payloads(made(spark, sf_dir, STATE)).select("page_url", "blob_count", F.array_join("top_level_keys", ",").alias("keys"))


@query("SELECT 'li[class*=''ad-card'']' AS selector, 'ad-card--x9y8z' AS raw_class, 2 * count(*) AS matches FROM part")
def learned_cards(spark, sf_dir):
    """AGG-12, STR-08."""
    return discovery.learn_cards(made(spark, sf_dir, CARDS))


@query("""
WITH h AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'ratnapura' WHEN 1 THEN lower(c_mktsegment) ELSE 'x' END AS slug, c_custkey % 3 AS k FROM customer)
SELECT slug, count(*) AS n FROM h WHERE k = 1 AND slug NOT IN ('ratnapura') GROUP BY slug
""")
def category_slugs(spark, sf_dir):
    """AGG-13."""
    k = F.col("c_custkey") % 3
    href = F.when(k == 0, "/en/ads/ratnapura").when(k == 1, F.concat(F.lit("https://x.example/en/ads/kandy/"), F.lower("c_mktsegment"), F.lit("/?a=1"))).otherwise("/en/ad/x")
    hrefs = table(spark, sf_dir, "customer").select(F.lit("p").alias("page_url"), F.col("c_custkey").cast("int").alias("pos"), href.alias("href"))
    return discovery.category_slugs(hrefs)


@query(_sql("'https://x.example/en/ads/p?page=' || k AS page_url, name || ' x' AS title", "'https://x.example/en/ads/p?page=' || k, 'second'"))
def read_samples(spark, sf_dir):
    """LIM-03."""
    return discovery.samples(P.reads(made(spark, sf_dir, _LD)).where("strategy = 'json-ld'")).select("page_url", "title")
