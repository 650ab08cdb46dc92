"""Queries for imports, audits, merges, reports and exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import choosing, importing, merging, reporting
from ..schemas import STORED_LISTING
from ..sources import markdown, tables, writers
from .registry import query, table

# Import of tables


def _markdown(spark, sf_dir):
    """A text per brand with two tables of unlike columns, made of ``part``."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    size = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 5 == 0, " acres").otherwise(" perches"))
    price = F.concat(F.lit("Rs "), F.floor(F.col("p_retailprice")).cast("string"), F.lit(",000 / perch"))
    title = F.concat(F.col("p_type"), F.when(F.col("p_partkey") % 7 == 0, " | corner").otherwise(""), F.lit(" lot "), k)
    place = F.when(F.col("p_partkey") % 3 == 0, "Kandy").when(F.col("p_partkey") % 3 == 1, "Ratnapura").otherwise("nowhere")
    rows = part.select("p_brand", "p_partkey", (F.col("p_partkey") % 2).alias("half"), F.concat(F.lit("| "), F.concat_ws(" | ", title, size, place, price), F.lit(" |")).alias("a"),
                       F.concat(F.lit("|"), F.concat_ws("|", title, place, size, price), F.lit("|")).alias("b"))
    lines = F.array_sort(F.collect_list(F.struct("p_partkey", "a", "b", "half")))

    def body(half: int, column: str):
        return F.array_join(F.transform(F.filter(F.col("rows"), lambda x: x["half"] == half), lambda x: x[column]), "\n")

    grouped = rows.groupBy("p_brand").agg(lines.alias("rows"))
    return grouped.select(
        F.col("p_brand").alias("doc"),
        F.concat(
            F.lit("some words\n| Title | Size | Location Listed | Price |\n|---|:--|---|---|\n"), body(0, "a"),
            F.lit("\n\nmore words\n| Name | Location | Extent | Asking price |\n| --- | --- | --- | --- |\n"), body(1, "b"), F.lit("\n"),
        ).alias("text"),
    )


_IMPORTED = """
WITH p AS (
  SELECT p_brand AS doc, p_partkey, p_type || CASE WHEN p_partkey % 7 = 0 THEN ' | corner' ELSE '' END || ' lot ' || p_partkey AS title,
         p_size::DOUBLE * CASE WHEN p_partkey % 5 = 0 THEN 160 ELSE 1 END AS size_perches, CASE WHEN p_partkey % 5 = 0 THEN 'acres' ELSE 'perches' END AS size_unit,
         floor(p_retailprice)::DOUBLE * 1000 AS price_amount,
         CASE p_partkey % 3 WHEN 0 THEN 'Kandy' WHEN 1 THEN 'Ratnapura' END AS district, (p_partkey % 2 + 1)::VARCHAR AS source_table FROM part),
q AS (
  SELECT *, price_amount * size_perches AS price_total, price_amount AS price_per_perch FROM p),
n AS (
  SELECT *, concat_ws(',', CASE WHEN price_per_perch < 10000 THEN 'per-perch-implausibly-low' WHEN price_per_perch > 5000000 THEN 'per-perch-implausibly-high' END,
    CASE WHEN price_total > 500000000 THEN 'total-implausibly-high' END, CASE WHEN price_per_perch >= 1500000 THEN 'per-perch-high-for-district' END,
    CASE WHEN district IS NULL THEN 'district-unverified' END) AS flags FROM q)
"""


@query(_IMPORTED + "SELECT doc, source_table, title, size_perches, size_unit, price_amount, price_total, district, district AS town, flags FROM n")
def markdown_import(spark, sf_dir):
    """SRC-06 to SRC-10, PRJ-02, FLT-12, WIN-01, WIN-02, SET-05."""
    rows = importing.normalise(markdown.table_rows(_markdown(spark, sf_dir)))
    return rows.select("doc", "source_table", "title", "size_perches", "size_unit", "price_amount", "price_total", "district", "town", F.array_join("flags", ",").alias("flags"))


@query(_IMPORTED + """, u AS (SELECT *, lower(title) || '|' || size_perches || '|' || price_amount AS key FROM n),
f AS (SELECT unnest(string_split(flags, ',')) AS flag FROM n WHERE flags <> '')
SELECT 'total' AS section, 'rows_parsed' AS key, count(*) AS n FROM u UNION ALL SELECT 'total', 'unique_adverts', count(DISTINCT key) FROM u
UNION ALL SELECT 'total', 'duplicate_rows', count(*) - count(DISTINCT key) FROM u UNION ALL SELECT 'total', 'in_district', count(*) FILTER (district = 'Ratnapura') FROM u
UNION ALL SELECT 'district', coalesce(district, '(unverified)'), count(*) FROM u GROUP BY 2 UNION ALL SELECT 'flag', split_part(flag, ':', 1), count(*) FROM f GROUP BY 2
""")
def import_summary(spark, sf_dir):
    """AGG-07, AGG-09, SET-06, STR-11."""
    return importing.summary(importing.normalise(markdown.table_rows(_markdown(spark, sf_dir))))


@query(_IMPORTED + "SELECT count(*) AS flagged, count(*) FILTER (district = 'Kandy') AS flagged_there FROM n WHERE flags <> ''")
def import_flagged(spark, sf_dir):
    """FLT-05, FLT-13."""
    rows = importing.flagged(importing.normalise(markdown.table_rows(_markdown(spark, sf_dir))))
    return rows.agg(F.count(F.lit(1)).alias("flagged"), F.count_if(F.col("district") == "Kandy").alias("flagged_there"))


@query(_IMPORTED + """SELECT title, 'LKR' AS currency, 'per perch' AS price_qualifier, price_total AS price_value,
 printf('%.1f', round(size_perches, 2)) AS size_attr, (price_amount::BIGINT)::VARCHAR AS rate_attr, CASE WHEN flags = '' THEN NULL ELSE '"' || replace(flags, ',', ', ') || '"' END AS flag_attr FROM n""")
def import_listings(spark, sf_dir):
    """PRJ-03, NUM-04."""
    rows = importing.to_listing(importing.normalise(markdown.table_rows(_markdown(spark, sf_dir))), F.lit("2026-01-01T00:00:00+00:00"))
    a = {n: F.try_element_at("attributes", F.lit(k)) for n, k in (("size_attr", "Size (perches)"), ("rate_attr", "Price per perch"), ("flag_attr", "Data flags"))}
    return rows.select("title", "currency", "price_qualifier", "price_value", *[c.alias(n) for n, c in a.items()])


# Audit


_AUDIT = """
WITH g AS (SELECT l_partkey, l_suppkey, count(*) AS n, percentile_disc(0.5) WITHIN GROUP (ORDER BY l_extendedprice DESC) AS median
           FROM lineitem WHERE l_extendedprice <> 0 GROUP BY 1, 2 HAVING count(*) >= 2)
"""


@query(_AUDIT + """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS total, median AS median_total FROM lineitem JOIN g USING (l_partkey, l_suppkey)
WHERE l_extendedprice <> 0 AND (l_extendedprice / median > 3 OR median / l_extendedprice > 3)""")
def conflict_audit(spark, sf_dir):
    """AGG-08, WIN-10: the flagship."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("total"))
    judged = importing.with_medians(rows, ["l_partkey", "l_suppkey"], "total")
    return judged.where(importing.is_outlier(F.col("total"), F.col("median_total")))


@query(_AUDIT + """, o AS (SELECT l_partkey, l_suppkey, median, l_extendedprice AS t, l_returnflag FROM lineitem JOIN g USING (l_partkey, l_suppkey) WHERE l_extendedprice <> 0)
SELECT 'part ' || l_partkey AS title, l_suppkey::DOUBLE AS size_perches, median AS median_total, count(DISTINCT l_returnflag || floor(t)) AS variants FROM o GROUP BY l_partkey, l_suppkey, median
HAVING bool_or(t / median > 3 OR median / t > 3)""")
def conflict_groups(spark, sf_dir):
    """AGG-08's report, SRT-07."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit(" Part "), F.col("l_partkey").cast("string")).alias("title"), F.col("l_suppkey").cast("double").alias("size_perches"),
        F.col("l_extendedprice").alias("price_total"), "l_returnflag",
    )
    text = F.concat("l_returnflag", F.floor("price_total").cast("string"))
    found = importing.conflicts(rows.withColumn("price_text", text))
    texts = F.array_distinct(F.transform("variants", lambda v: F.substring_index(v, " => ", 1)))
    return found.select("title", "size_perches", "median_total", F.size(texts).cast("long").alias("variants"))


@query("""
WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS size, l_extendedprice * 100 AS amount, l_returnflag AS flag, l_linestatus AS status FROM lineitem),
u AS (SELECT *, CASE flag WHEN 'A' THEN 'perch' WHEN 'N' THEN 'total' END AS basis, CASE status WHEN 'O' THEN 'Colombo' END AS district FROM t),
v AS (SELECT *, CASE basis WHEN 'perch' THEN amount ELSE amount / nullif(size, 0) END AS per_perch, CASE basis WHEN 'perch' THEN amount * nullif(size, 0) ELSE amount END AS total FROM u)
SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN basis IS NULL THEN 'price-basis-unstated' END,
  CASE WHEN per_perch < 10000 THEN 'per-perch-implausibly-low' WHEN per_perch > 5000000 THEN 'per-perch-implausibly-high' END,
  CASE WHEN total > 500000000 THEN 'total-implausibly-high' END,
  CASE WHEN per_perch >= 1500000 AND district IS NULL THEN 'per-perch-high-for-district' END,
  CASE WHEN district IS NULL THEN 'district-unverified' WHEN l_linenumber = 1 THEN 'location-mismatch:listed-Kandy-actually-Colombo' END,
  CASE WHEN l_linenumber = 2 THEN 'size-unit-conflicts-with-title' END) AS flags FROM v
""")
def row_flags(spark, sf_dir):
    """FLT-12: every kind of flag."""
    from ..functions import money

    rows = table(spark, sf_dir, "lineitem")
    basis = F.when(F.col("l_returnflag") == "A", "perch").when(F.col("l_returnflag") == "N", "total")
    amount = F.col("l_extendedprice") * 100
    district = F.when(F.col("l_linestatus") == "O", "Colombo")
    rows = rows.withColumn("m", money.totals(amount, basis, F.col("l_quantity")))
    flags = importing.flags_of(
        basis, amount, F.col("l_quantity"), F.lit("perches"), F.col("m.per_perch"), F.col("m.total"), district,
        F.when(F.col("l_linenumber") == 1, "Kandy"), F.when(F.col("l_linenumber") == 2, "2 Acres of land").otherwise("land"),
    )
    return rows.select("l_orderkey", "l_linenumber", F.array_join(flags, ",").alias("flags"))


# Merges


def _observations(spark, sf_dir):
    """Listing-shaped observations per user, in the order of event_id."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    url = F.concat(F.lit("https://x.example/en/ad/u-"), F.col("user_id").cast("string"))
    kind = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    rows = e.select(
        F.col("user_id").cast("string").alias("listing_id"), url.alias("url"),
        F.when(k % 3 == 0, F.col("event_type")).when(k % 3 == 1, "").alias("title"),
        F.when(k % 4 == 0, 0.0).when(k % 4 == 1, F.floor("value").cast("double")).alias("price_value"),
        (k % 5 == 0).alias("is_promoted"), F.concat(F.lit("t"), F.lpad(k.cast("string"), 9, "0")).alias("scraped_at"),
        F.create_map(F.concat(F.lit("k"), (k % 3).cast("string")), kind).alias("attributes"),
        F.array(F.concat(F.lit("i"), (k % 4).cast("string"))).alias("image_urls"), k.alias("seq"),
    )
    return merging.complete(rows, keep=["seq"])


_OBSERVED = """
WITH e AS (SELECT user_id, event_id AS seq, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN '' END AS title,
  CASE event_id % 4 WHEN 0 THEN 0.0 WHEN 1 THEN floor(value)::DOUBLE END AS price, event_id % 5 = 0 AS promoted, event_type, event_id % 3 AS k3, event_id % 4 AS k4 FROM events)
"""


@query(_OBSERVED + """SELECT user_id::VARCHAR AS listing_id,
  coalesce(arg_max(title, seq) FILTER (title <> ''), arg_min(coalesce(title, '~'), seq)) AS title,
  coalesce(arg_max(price, seq) FILTER (price <> 0), CASE WHEN arg_min(coalesce(price, -1), seq) = 0 THEN 0 END) AS price_value,
  arg_max(promoted, seq) AS is_promoted, 't' || lpad(min(seq)::VARCHAR, 9, '0') AS scraped_at FROM e GROUP BY user_id""")
def merge_fold(spark, sf_dir):
    """AGG-10, JON-06, SNK-01, STM-03. A first title that is null shows as ~."""
    out = merging.fold(_observations(spark, sf_dir))
    return out.select("listing_id", F.coalesce("title", F.lit("~")).alias("title"), "price_value", "is_promoted", "scraped_at")


@query(_OBSERVED + """, m AS (SELECT user_id, k3, arg_max(event_type, seq) AS v FROM e GROUP BY 1, 2)
SELECT user_id::VARCHAR AS listing_id, string_agg('k' || k3 || '="' || v || '"', ',' ORDER BY k3) AS attributes FROM m GROUP BY user_id""")
def map_merge(spark, sf_dir):
    """MAP-01."""
    out = merging.fold(_observations(spark, sf_dir))
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return out.select("listing_id", F.array_join(pairs, ",").alias("attributes"))


@query(_OBSERVED + """, f AS (SELECT user_id, k4, min(seq) AS s FROM e GROUP BY 1, 2)
SELECT user_id::VARCHAR AS listing_id, string_agg('i' || k4, ',' ORDER BY s) AS images FROM f GROUP BY user_id""")
def image_union(spark, sf_dir):
    """SET-03, SET-04, PRJ-06."""
    return merging.fold(_observations(spark, sf_dir)).select("listing_id", F.array_join("image_urls", ",").alias("images"))


@query("""
WITH e AS (SELECT user_id, event_id FROM events), o AS (SELECT DISTINCT user_id FROM e WHERE event_id % 2 = 0), i AS (SELECT * FROM e WHERE event_id % 2 = 1)
SELECT (SELECT count(DISTINCT user_id) FROM i WHERE user_id NOT IN (SELECT user_id FROM o)) AS new,
       (SELECT count(*) FROM i) - (SELECT count(DISTINCT user_id) FROM i WHERE user_id NOT IN (SELECT user_id FROM o)) AS updated
""")
def upsert_batch(spark, sf_dir):
    """SNK-02."""
    rows = _observations(spark, sf_dir)
    return merging.upsert_counts(merging.fold(rows.where("seq % 2 = 0")), rows.where("seq % 2 = 1"))


@query(_OBSERVED + """, s AS (SELECT user_id, arg_max(title, seq) FILTER (title <> '') AS last, min(seq) AS first_seen, arg_max(promoted, seq) AS p, 0 AS nth FROM e WHERE seq % 2 = 0 GROUP BY 1
UNION ALL SELECT user_id, arg_max(title, seq) FILTER (title <> ''), min(seq), arg_max(promoted, seq), 1 FROM e WHERE seq % 2 = 1 GROUP BY 1)
SELECT user_id::VARCHAR AS listing_id, coalesce(arg_max(last, nth) FILTER (last IS NOT NULL), '') AS title, arg_max(p, nth) AS is_promoted, 't' || lpad(arg_min(first_seen, nth)::VARCHAR, 9, '0') AS scraped_at FROM s GROUP BY user_id""")
def upsert_snapshot(spark, sf_dir):
    """SNK-01 over two batches: the stored snapshot comes first, whatever the order of its observations."""
    rows = _observations(spark, sf_dir)
    out = merging.upsert(merging.fold(rows.where("seq % 2 = 0")), rows.where("seq % 2 = 1"))
    return out.select("listing_id", F.coalesce("title", F.lit("")).alias("title"), "is_promoted", "scraped_at")


# Choosing


@query("""
SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations) WHERE r = 1
""")
def dedup_first(spark, sf_dir):
    """WIN-03."""
    return choosing.first_by(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "role"], "turn")


_READS = """
WITH r AS (SELECT user_id::VARCHAR AS page_url, event_type AS strategy, dense_rank() OVER (ORDER BY event_type) AS o,
  (event_id % 2)::INT + (event_id % 3 = 0)::INT AS filled FROM events),
s AS (SELECT page_url, strategy, o, count(*) AS n, avg(filled) AS fill FROM r GROUP BY 1, 2, 3)
"""


def _reads(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    names = e.select("event_type").distinct()
    ranks = names.withColumn("strategy_ord", F.dense_rank().over(Window.orderBy("event_type")))  # a handful of types
    none = F.lit(None).cast("string")
    return e.join(F.broadcast(ranks), "event_type").select(
        F.col("user_id").cast("string").alias("page_url"), F.col("event_type").alias("strategy"), "strategy_ord",
        F.when(F.col("event_id") % 2 == 1, "t").alias("title"), F.when(F.col("event_id") % 3 == 0, "p").alias("price_text"),
        none.alias("location_text"), F.lit("").alias("posted_text"),
    )


@query(_READS + "SELECT page_url, strategy, n, round(fill, 6) AS fill FROM s")
def strategy_scores(spark, sf_dir):
    """AGG-11, AGG-15."""
    return choosing.strategy_scores(_reads(spark, sf_dir)).select("page_url", "strategy", "n", F.round("fill", 6).alias("fill"))


@query(_READS + "SELECT page_url, strategy, n AS listings FROM (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY n DESC, fill DESC, o) AS k FROM s) WHERE k = 1")
def best_strategy(spark, sf_dir):
    """WIN-04, WIN-08."""
    return choosing.best_strategy(choosing.strategy_scores(_reads(spark, sf_dir)))


# Reports


def stored_listings(spark, sf_dir):
    """Customers as stored listings."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    rows = c.select(
        F.lpad(k.cast("string"), 16, "0").alias("listing_id"), F.concat(F.lit("/en/ad/"), k.cast("string")).alias("url"), F.col("c_name").alias("title"),
        F.when(k % 3 != 0, F.col("c_acctbal")).alias("price_value"), F.col("c_mktsegment").alias("category"),
        F.when(k % 7 == 0, None).when(k % 7 == 1, "").otherwise(F.col("n_name")).alias("town"), F.when(k % 2 == 0, "Kandy").alias("district"),
        F.when(k % 5 == 0, None).otherwise(F.concat(F.lit("s"), (k % 4).cast("string"))).alias("extracted_by"),
        F.concat(F.lit("t"), F.lpad((k * 7919 % 1009).cast("string"), 6, "0")).alias("scraped_at"),
        F.create_map(F.concat(F.lit("Key "), (k % 3).cast("string")), F.concat(F.lit('"v'), (k % 10).cast("string"), F.lit('"'))).alias("attributes"),
        F.array("c_name", "c_mktsegment").alias("image_urls"),
    )
    return merging.complete(rows).withColumn("detail_fetched", (F.col("listing_id").cast("long") % 4 == 0).cast("int"))


LISTINGS = """
WITH l AS (SELECT c_custkey AS k, lpad(c_custkey::VARCHAR, 16, '0') AS listing_id, '/en/ad/' || c_custkey AS url, c_name AS title, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS price_value,
  c_mktsegment AS category, CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE n_name END AS town, CASE WHEN c_custkey % 2 = 0 THEN 'Kandy' END AS district,
  CASE WHEN c_custkey % 5 <> 0 THEN 's' || (c_custkey % 4) END AS extracted_by, 't' || lpad((c_custkey * 7919 % 1009)::VARCHAR, 6, '0') AS scraped_at, (c_custkey % 4 = 0)::INT AS detail_fetched
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""


@query(LISTINGS + """SELECT 'total' AS section, 'listings' AS key, count(*) AS n FROM l UNION ALL SELECT 'total', 'with_detail', count(*) FILTER (detail_fetched = 1) FROM l
UNION ALL SELECT 'total', 'with_price', count(price_value) FROM l UNION ALL SELECT 'total', 'pages_visited', (SELECT count(*) FROM pages)
UNION ALL SELECT 'town', coalesce(nullif(town, ''), '(unknown)'), count(*) FROM l GROUP BY 2 UNION ALL SELECT 'category', coalesce(nullif(category, ''), '(unknown)'), count(*) FROM l GROUP BY 2
UNION ALL SELECT 'strategy', coalesce(nullif(extracted_by, ''), '(unknown)'), count(*) FROM l GROUP BY 2""")
def stats_report(spark, sf_dir):
    """AGG-01 to AGG-05, FLT-04, SRT-03."""
    return reporting.stats(stored_listings(spark, sf_dir), table(spark, sf_dir, "pages"))


@query(LISTINGS + "SELECT town, category, count(*) AS n, round(avg(price_value)) AS mean_price FROM l WHERE price_value > 0 GROUP BY town, category")
def town_category_sql(spark, sf_dir):
    """AGG-06: the documented report, in SQL."""
    return reporting.mean_price_by_town(stored_listings(spark, sf_dir))


@query("SELECT p_type AS key, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, key LIMIT 25")
def topk_categories(spark, sf_dir):
    """AGG-04, SRT-03, SRT-04."""
    return reporting.counts_by(table(spark, sf_dir, "part"), "p_type", 25)


@query(LISTINGS + "SELECT url FROM l WHERE detail_fetched = 0 ORDER BY scraped_at, url LIMIT 100")
def ordered_pending(spark, sf_dir):
    """SRT-02, FLT-02, JON-13."""
    return reporting.pending_details(stored_listings(spark, sf_dir), 100)


@query(LISTINGS + "SELECT listing_id, url, title FROM l WHERE district = 'Kandy'")
def district_scan(spark, sf_dir):
    """SRC-13, FLT-01, SRT-01, PRJ-07."""
    return reporting.scan(stored_listings(spark, sf_dir), "Kandy").select("listing_id", "url", "title")


@query(LISTINGS + "SELECT listing_id, title FROM l WHERE url = '/en/ad/17'")
def point_lookup(spark, sf_dir):
    """SRC-14."""
    return reporting.lookup(stored_listings(spark, sf_dir), "/en/ad/17").select("listing_id", "title")


@query(LISTINGS + """SELECT listing_id, title || ' | ' || category AS image_urls, CASE WHEN k % 3 = 0 THEN '"v' || (k % 10) || '"' END AS attr_key_0,
CASE WHEN k % 3 = 1 THEN '"v' || (k % 10) || '"' END AS attr_key_1, CASE WHEN k % 3 = 2 THEN '"v' || (k % 10) || '"' END AS attr_key_2 FROM l""")
def attr_pivot(spark, sf_dir):
    """PRJ-05, PRJ-06, SRT-05, STR-10: attributes as columns, found in the data."""
    flat = writers.flatten(stored_listings(spark, sf_dir))
    return flat.select("listing_id", "image_urls", *[c for c in flat.columns if c.startswith("attr_")])


@query(LISTINGS + """SELECT listing_id, '{"Key ' || (k % 3) || '":"\\"v' || (k % 10) || '\\""}' AS attributes FROM l""")
def plain_rows(spark, sf_dir):
    """PRJ-01, JSN-01: nested values as JSON text."""
    return writers.plain(stored_listings(spark, sf_dir)).select("listing_id", "attributes")


@query(LISTINGS + "SELECT listing_id, greatest(detail_fetched, (k % 6 = 0)::INT) AS detail_fetched FROM l")
def mark_details(spark, sf_dir):
    """SNK-09."""
    rows = stored_listings(spark, sf_dir)
    return merging.mark_detail(rows, rows.where(F.col("listing_id").cast("long") % 6 == 0).select("url")).select("listing_id", "detail_fetched")


@query(LISTINGS + "SELECT listing_id, url, NULL::VARCHAR AS seller_name, detail_fetched FROM l")
def migrated_layout(spark, sf_dir):
    """SNK-10: an older layout gains the columns it lacks."""
    old = stored_listings(spark, sf_dir).select("listing_id", "url", "detail_fetched", F.lit(1).alias("dropped"))
    return tables.migrate(old, STORED_LISTING).select("listing_id", "url", "seller_name", "detail_fetched")


@query("""
WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role || turn END AS header FROM conversations)
SELECT conv_id, turn, last_value(header IGNORE NULLS) OVER w AS header, count(header) OVER w AS table_no FROM t
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def header_carry(spark, sf_dir):
    """WIN-01, WIN-02."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    header = F.when(F.col("turn") % 3 == 0, F.concat("role", F.col("turn").cast("string")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", header.alias("h"))
    return rows.select("conv_id", "turn", F.last("h", ignorenulls=True).over(w).alias("header"), F.count("h").over(w).alias("table_no"))
