"""Queries for the scalar functions, on columns derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dims
from ..functions import dates, money, places, text
from ..operators import lookups
from ..sources import tables as T
from .registry import query, table

NOW = "2026-07-01 12:00:00"


@query("""
WITH t AS (
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Free' WHEN 1 THEN 'Ask for price' WHEN 2 THEN '' ELSE '' END AS special,
         CASE o_orderkey % 6 WHEN 3 THEN ' Negotiable' WHEN 4 THEN ' per month' ELSE '' END AS tail,
         CASE WHEN o_orderkey % 6 = 5 THEN '' ELSE 'Rs ' END AS head, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS amount FROM orders)
SELECT o_orderkey,
       CASE WHEN special = 'Free' THEN 0.0 WHEN special = 'Ask for price' THEN NULL ELSE CAST(amount AS DOUBLE) END AS value,
       CASE WHEN special = 'Free' THEN 'LKR' WHEN special = 'Ask for price' THEN NULL WHEN head = 'Rs ' THEN 'LKR' END AS currency,
       CASE WHEN special <> '' THEN CASE special WHEN 'Free' THEN 'Free' ELSE 'Ask for price' END
            WHEN tail = ' Negotiable' THEN 'Negotiable' WHEN tail = ' per month' THEN 'Per Month' END AS qualifier
FROM t
""")
def price_parse(spark, sf_dir):
    """STR-02."""
    k = F.col("o_orderkey") % 6
    amount = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    shown = (
        F.when(k == 0, "Free").when(k == 1, "Ask for price").when(k == 5, amount)
        .otherwise(F.concat(F.lit("Rs "), amount, F.when(k == 3, " Negotiable").when(k == 4, " per month").otherwise("")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", money.parse_price(shown).alias("p")).select("o_orderkey", "p.*")


@query("""
WITH t AS (SELECT o_orderkey, o_orderkey % 8 AS k, (o_orderkey % 40)::INT AS n FROM orders)
SELECT o_orderkey, CASE k
  WHEN 0 THEN '2026-07-01T12:00:00+00:00' WHEN 1 THEN '2026-07-01T00:00:00+00:00' WHEN 2 THEN '2026-06-30T00:00:00+00:00'
  WHEN 3 THEN strftime(TIMESTAMP '2026-07-01 12:00:00' - to_days(n), '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 4 THEN strftime(TIMESTAMP '2026-07-01 12:00:00' - to_hours(n), '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 5 THEN strftime(TIMESTAMP '2026-07-01 12:00:00' - to_days(30 * n), '%Y-%m-%dT%H:%M:%S') || '+00:00'
  WHEN 6 THEN '2026-01-' || lpad((1 + n % 28)::VARCHAR, 2, '0') || 'T00:00:00+00:00' END AS posted_at
FROM t
""")
def posted_parse(spark, sf_dir):
    """DAT-01, STM-06."""
    k, n = F.col("o_orderkey") % 8, (F.col("o_orderkey") % 40).cast("int")
    day = (n % 28 + 1).cast("string")
    shown = (
        F.when(k == 0, "Just now").when(k == 1, "Today").when(k == 2, " yesterday ").when(k == 3, F.concat(n.cast("string"), F.lit(" days ago")))
        .when(k == 4, F.concat(n.cast("string"), F.lit(" hr ago"))).when(k == 5, F.concat(n.cast("string"), F.lit(" months  ago")))
        .when(k == 6, F.concat(day, F.lit(" Jan 2026"))).otherwise("some day")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_posted(shown, F.lit(NOW).cast("timestamp")).alias("posted_at"))


@query("""
SELECT c_custkey,
       CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'Balangoda' ELSE 'Ratnapura' END AS town,
       CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 'Ratnapura' END AS district
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def location_split(spark, sf_dir):
    """STR-03, JON-04."""
    k = F.col("c_custkey") % 3
    shown = F.when(k == 0, F.concat("n_name", F.lit(" , somewhere"))).when(k == 1, "Ratnapura District, balangoda").otherwise(" ratnapura ")
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", places.split_location(shown).alias("x")).select("c_custkey", "x.*")


@query("""
WITH t AS (SELECT p_partkey, p_size::DOUBLE AS s, floor(p_retailprice)::DOUBLE AS a, p_partkey % 4 AS k FROM part),
u AS (SELECT p_partkey, a AS amount,
        CASE k WHEN 0 THEN s WHEN 1 THEN s * 160 WHEN 2 THEN s / 25.2929 ELSE s END AS perches,
        CASE k WHEN 0 THEN 'perches' WHEN 1 THEN 'acres' WHEN 2 THEN 'sqm' END AS unit,
        CASE k WHEN 0 THEN 'perch' WHEN 1 THEN 'acre' WHEN 2 THEN 'total' END AS basis FROM t)
SELECT p_partkey, round(perches, 2) AS perches, unit, amount, basis,
       round(CASE basis WHEN 'perch' THEN amount * perches WHEN 'acre' THEN amount * (perches / 160) ELSE amount END, 2) AS total,
       round(CASE basis WHEN 'perch' THEN amount WHEN 'acre' THEN amount / 160 ELSE amount / nullif(perches, 0) END, 2) AS per_perch
FROM u
""")
def size_basis_normalise(spark, sf_dir):
    """NUM-01 to NUM-04."""
    k = F.col("p_partkey") % 4
    size = F.concat(F.col("p_size").cast("string"), F.when(k == 0, " perches").when(k == 1, " acres").when(k == 2, " sq meters").otherwise(""))
    price = F.concat(F.lit("Rs "), F.format_number(F.floor("p_retailprice"), 0), F.when(k == 0, " / perch").when(k == 1, " per acre").when(k == 2, " total").otherwise(""))
    read = table(spark, sf_dir, "part").select("p_partkey", money.parse_size(size).alias("s"), money.parse_price_basis(price).alias("p"))
    m = money.totals(F.col("p.amount"), F.col("p.basis"), F.col("s.perches"))
    return read.select(
        "p_partkey", F.round("s.perches", 2).alias("perches"), "s.unit", "p.amount", "p.basis",
        F.round(m["total"], 2).alias("total"), F.round(m["per_perch"], 2).alias("per_perch"),
    )


@query("SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    """STR-01."""
    return table(spark, sf_dir, "documents").select("doc_id", text.clean(F.col("text")).alias("cleaned"))


@query("""
SELECT c_custkey, arg_min(n.n_name, (-length(n.n_name))::BIGINT * 1000 + n.n_nationkey) AS found
FROM (SELECT c_custkey, c_name || ' at ' || m.n_name AS place FROM customer JOIN nation m ON c_nationkey = m.n_nationkey) c
JOIN nation n ON contains(c.place, n.n_name) GROUP BY c_custkey
""")
def theta_lookup_longest(spark, sf_dir):
    """JON-01, SRT-06: the longest name wins, as short names are parts of long ones."""
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("c_custkey", F.concat("c_name", F.lit(" at "), "n_name").alias("place"))
    return lookups.theta_lookup(rows, "place", nation, "n_name", "n_nationkey").select("c_custkey", "found")


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Eheliyagoda' WHEN 1 THEN 'Ja-Ela' WHEN 2 THEN 'Ratnapura' WHEN 3 THEN 'Uda Kandha' END AS town,
       CASE p_partkey % 5 WHEN 0 THEN 'Ratnapura' WHEN 1 THEN 'Gampaha' WHEN 2 THEN 'Ratnapura' WHEN 3 THEN 'Ratnapura' END AS district
FROM part
""")
def town_in_title(spark, sf_dir):
    """JON-01 on the gazetteer, JON-03, SRC-17."""
    k = F.col("p_partkey") % 5
    title = F.concat(F.col("p_name"), F.when(k == 0, " ahaliyagoda").when(k == 1, " JA-ELA land").when(k == 2, " රත්නපුර").when(k == 3, " in Uda Kandha, Kandy").otherwise(" ballella"))
    return table(spark, sf_dir, "part").select("p_partkey", places.find_town(title).alias("x")).select("p_partkey", "x.*")


@query("""
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'Colombo' WHEN 1 THEN 'Kandy' WHEN 2 THEN 'Matara' END AS district FROM supplier
""")
def district_exact(spark, sf_dir):
    """JON-02."""
    k = F.col("s_suppkey") % 4
    name = F.when(k == 0, "Maharagama Town").when(k == 1, " kandy district").when(k == 2, "WELIGAMA city, ").otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", places.district_of(name).alias("district"))


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Buildings' WHEN 'AUTOMOBILE' THEN 'Vehicles' ELSE c_mktsegment END AS category FROM customer
""")
def dim_lookup_left(spark, sf_dir):
    """JON-03 and JON-05: a literal table, left outer, with a default."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = lookups.equi_lookup(rows, F.lower("c_mktsegment"), {"building": "Buildings", "automobile": "Vehicles"}, "category", F.col("c_mktsegment"))
    return out.select("c_custkey", "category")


@query(r"SELECT page_id, sha1(regexp_replace(regexp_replace(split_part(url, '?', 1), '^https?://[^/]+', ''), '/+$', ''))[1:16] AS listing_id FROM pages")
def url_id(spark, sf_dir):
    """STR-05, PRJ-01."""
    return table(spark, sf_dir, "pages").select("page_id", text.listing_id(F.col("url")).alias("listing_id"))


@query(r"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' & ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slugify(spark, sf_dir):
    """STR-04."""
    return table(spark, sf_dir, "part").select("p_partkey", text.slugify(F.concat("p_name", F.lit(" & "), "p_type")).alias("slug"))


@query(r"""
WITH t AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_replace(url, '^(https?://[^/]+).*$', '\1/en/ad/') || page_id || '?x=1'
                                WHEN 1 THEN '/si/ad/a-' || page_id || '/' WHEN 2 THEN '/en/ad/a/b' ELSE url END AS href FROM pages)
SELECT page_id, href FROM t WHERE regexp_matches(regexp_replace(regexp_replace(href, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '^/(?:en|si|ta)/ad/[^/?#]+/?$')
""")
def ad_url_filter(spark, sf_dir):
    """FLT-06."""
    k = F.col("page_id") % 4
    href = (
        F.when(k == 0, F.concat(F.regexp_extract("url", "^(https?://[^/]+)", 1), F.lit("/en/ad/"), F.col("page_id").cast("string"), F.lit("?x=1")))
        .when(k == 1, F.concat(F.lit("/si/ad/a-"), F.col("page_id").cast("string"), F.lit("/"))).when(k == 2, "/en/ad/a/b").otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", href.alias("href")).where(text.is_ad_url(F.col("href")))


@query("""
SELECT p_partkey, sha1(lower(trim(p_name)) || '|' || (p_size::DOUBLE)::VARCHAR || '|' || CASE WHEN p_partkey % 3 = 0 THEN 'None' ELSE (floor(p_retailprice)::DOUBLE)::VARCHAR END)[1:16] AS row_key FROM part
""")
def import_key(spark, sf_dir):
    """Identity of imported rows."""
    amount = F.when(F.col("p_partkey") % 3 != 0, F.floor("p_retailprice").cast("double"))
    return table(spark, sf_dir, "part").select("p_partkey", text.row_key(F.concat(F.lit(" "), "p_name"), F.col("p_size").cast("double"), amount).alias("row_key"))


@query("""
SELECT n_nationkey, n_name, 'https://example.org/en/ads/' || lower(n_name) || CASE n_nationkey % 3 WHEN 0 THEN '' ELSE '/' || lower(r_name) END
       || CASE WHEN n_nationkey % 4 > 1 THEN '?page=' || (n_nationkey % 4) ELSE '' END AS url,
       CASE WHEN n_nationkey % 4 > 1 THEN (n_nationkey % 4)::INT ELSE 1 END AS page
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def search_urls(spark, sf_dir):
    """STR-07, STR-12."""
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    plain, wide = (F.lit(t) for t in dims.PATH_TEMPLATES[0])
    category = F.when(F.col("n_nationkey") % 3 != 0, F.lower("r_name"))
    url = text.search_url(F.lit("https://example.org/"), F.when(category.isNull(), plain).otherwise(wide), F.lit("en"), F.lower("n_name"), category, F.col("n_nationkey") % 4)
    return joined.select("n_nationkey", "n_name", url.alias("url")).withColumn("page", text.page_number(F.col("url")))


@query("""
SELECT p_partkey, 'ad-card' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '_x' END AS stem, 'attr_' || replace(lower(trim(p_type)), ' ', '_') AS attribute,
       'kind-' || (p_partkey % 3) AS kind FROM part
""")
def names_normalised(spark, sf_dir):
    """STR-08, STR-10, STR-11."""
    k = F.col("p_partkey").cast("string")
    cls = F.concat(F.lit("ad-card"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("--a1B2c"), k)).otherwise("_x"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.stable_class(cls).alias("stem"), text.attribute_column(F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("attribute"),
        text.flag_kind(F.concat(F.lit("kind-"), (F.col("p_partkey") % 3).cast("string"), F.lit(":more:"), k)).alias("kind"),
    )


@query("""
SELECT p_partkey, '["' || p_brand || '","' || p_type || '"]' AS images, '{"size":"' || p_size || '"}' AS attributes, (p_partkey % 2)::INT AS promoted,
       2::INT AS n_images, p_size::VARCHAR AS size_again, p_partkey % 2 = 1 AS promoted_again FROM part
""")
def json_round_trip(spark, sf_dir):
    """SRC-15, JSN-01: nested columns as text and back."""
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.array("p_brand", "p_type").alias("image_urls"), F.create_map(F.lit("size"), F.col("p_size").cast("string")).alias("attributes"),
        (F.col("p_partkey") % 2 == 1).alias("is_promoted"),
    )
    stored = T.encode(rows).withColumns({"images": F.col("image_urls"), "stored": F.col("attributes"), "promoted": F.col("is_promoted")})
    back = T.decode(stored)
    return back.select(
        "p_partkey", "images", F.col("stored").alias("_a"), "promoted", F.size("image_urls").alias("n_images"),
        F.element_at("attributes", "size").alias("size_again"), F.col("is_promoted").alias("promoted_again"),
    ).withColumnRenamed("_a", "attributes")
