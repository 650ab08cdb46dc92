"""Imported table rows: normalise, flag, audit, summarise, map to listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import money, places
from ..functions.text import clean, computed, flag_kind, listing_id, row_key, strip
from ..schemas import ROW_COLUMNS
from ..sources.shared import staged


def flags_of(price_basis: Column, amount: Column, perches: Column, unit: Column, per_perch: Column, total: Column,
             district: Column, listed_district: Column, title: Column) -> Column:
    """What looks wrong about a row, in a fixed order. Nothing is corrected."""
    in_city = F.coalesce(district.isin(dims.CITY_DISTRICTS), F.lit(False))
    mismatch = F.concat(F.lit("location-mismatch:listed-"), listed_district, F.lit("-actually-"), district)
    return F.array_compact(F.array(
        F.when(price_basis.isNull() & amount.isNotNull(), "price-basis-unstated"),
        F.when(perches.isNull(), "size-unparsed"),
        F.when(per_perch < dims.MIN_PER_PERCH, "per-perch-implausibly-low").when(per_perch > dims.MAX_PER_PERCH, "per-perch-implausibly-high"),
        F.when(total > dims.MAX_TOTAL, "total-implausibly-high"),
        F.when((per_perch >= dims.HIGH_PER_PERCH) & ~in_city, "per-perch-high-for-district"),
        F.when(district != listed_district, mismatch).when(district.isNull(), "district-unverified"),
        F.when((unit == "perches") & title.rlike(r"(?iU)\d+(?:\.\d+)?\s*acre"), "size-unit-conflicts-with-title"),
    ))


def normalise(rows: DataFrame) -> DataFrame:
    """Typed and flagged rows; the given texts stay beside what was read from them."""
    out = rows.select(
        *[c for c in ("doc", "line") if c in rows.columns],
        F.coalesce(clean(F.col("title")), F.lit("")).alias("title"), clean(F.col("location")).alias("location_listed"),
        clean(F.col("size")).alias("size_text"), clean(F.col("price")).alias("price_text"), "source_table",
    )
    out = computed(out, {
        "_size": money.parse_size(F.col("size_text")), "_price": money.parse_price_basis(F.col("price_text")),
        "_named": places.find_town(F.col("title")), "_listed": places.find_town(F.col("location_listed")),
        "_exact": places.district_of(F.col("location_listed")),
    })
    out = out.withColumns({
        "size_perches": F.col("_size.perches"), "size_unit": F.col("_size.unit"),
        "price_amount": F.col("_price.amount"), "price_basis": F.col("_price.basis"),
        "town": F.coalesce("_named.town", "_listed.town"),
        "district": F.when(F.col("_named.town").isNotNull(), F.col("_named.district")).otherwise(F.coalesce("_listed.district", "_exact")),
    })
    out = out.withColumns({
        "district_source": F.when(F.col("_named.town").isNotNull(), "title").when(F.col("district").isNotNull(), "location-column"),
        "_money": money.totals(F.col("price_amount"), F.col("price_basis"), F.col("size_perches")),
    })
    out = out.withColumns({"price_total": F.col("_money.total"), "price_per_perch": F.col("_money.per_perch")})
    flags = flags_of(
        F.col("price_basis"), F.col("price_amount"), F.col("size_perches"), F.col("size_unit"), F.col("price_per_perch"),
        F.col("price_total"), F.col("district"), F.coalesce("_exact", "_listed.district"), F.col("title"),
    )
    out = out.withColumns({"flags": flags, "row_key": row_key(F.col("title"), F.col("size_perches"), F.col("price_amount"))})
    return out.drop("_size", "_price", "_named", "_listed", "_exact", "_money")


#: Groups of more rows than this are no window partitions: their medians come from an aggregate
#: that combines map-side.
HOT_ROWS = 1 << 20


def _ranked_medians(rows: DataFrame, keys: list[str], total: str) -> DataFrame:
    """``median_total`` by one sort of each group: of n non-zero totals, the one in place ceil(n / 2) from the top."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_value"))
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = rows.withColumn("_value", F.when(F.col(total) != 0, F.col(total)))
    ranked = ranked.withColumns({"_place": F.row_number().over(order), "_n": F.count("_value").over(group)})
    middle = F.when((F.col("_n") >= 2) & (F.col("_place") == F.ceil(F.col("_n") / 2)), F.col("_value"))
    return ranked.withColumn("median_total", F.max(middle).over(group)).drop("_value", "_place", "_n")


def _combined_medians(rows: DataFrame, hot: DataFrame, keys: list[str], total: str) -> DataFrame:
    """The same for the groups in ``hot``, by an aggregate and a join back, which may both be split."""
    grouped = rows.where(F.col(total) != 0).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {total} DESC)").alias("_middle")
    )
    medians = grouped.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)], F.when(F.col("_n") >= 2, F.col("_middle")).alias("median_total"))
    return rows.join(medians, _same(keys), "left").drop(*[f"_{i}" for i in range(len(keys))])


def _same(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])


def with_medians(rows: DataFrame, keys: list[str], total: str) -> DataFrame:
    """Adds ``median_total``, the upper median of the non-zero totals of each row's group, null in groups
    with fewer than two. One shuffle on the keys; groups beyond ``HOT_ROWS`` are found first and go apart."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS)
    if counted.isEmpty():
        return _ranked_medians(rows, keys, total)
    hot = counted.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    apart = [rows.join(hot, _same(keys), how) for how in ("left_semi", "left_anti")]
    return _combined_medians(apart[0], hot, keys, total).unionByName(_ranked_medians(apart[1], keys, total))


def is_outlier(total: Column, median: Column, ratio: float = dims.OUTLIER_RATIO) -> Column:
    t, m = F.nullif(total, F.lit(0.0)), F.nullif(median, F.lit(0.0))
    return F.coalesce((t / m > ratio) | (m / t > ratio), F.lit(False))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_title": F.lower(strip(F.col("title"))), "_size": F.col("size_perches")})


def audit(rows: DataFrame) -> DataFrame:
    """Rows with ``price-conflicts-with-duplicate`` appended where a total is far from its group's median.

    Groups are (lower-cased title, size); an unknown size is a size, an unknown title no group.
    """
    judged = with_medians(_keyed(rows), ["_title", "_size"], "price_total")
    outlier = is_outlier(F.col("price_total"), F.col("median_total")) & F.col("_title").isNotNull()
    flags = F.when(outlier, F.array_append("flags", F.lit("price-conflicts-with-duplicate"))).otherwise(F.col("flags"))
    return judged.withColumn("flags", flags).select(*rows.columns)


def conflicts(rows: DataFrame) -> DataFrame:
    """One row per group with an outlier: title, size_perches, median_total, variants."""
    keyed = _keyed(rows).where("price_total != 0 and _title is not null")
    judged = with_medians(keyed, ["_title", "_size"], "price_total").where("median_total is not null")
    variant = F.concat(F.coalesce("price_text", F.lit("None")), F.lit(" => total "), F.format_number("price_total", 0))
    grouped = judged.groupBy(F.col("_title").alias("title"), F.col("_size").alias("size_perches"), "median_total").agg(
        F.bool_or(is_outlier(F.col("price_total"), F.col("median_total"))).alias("_any"), F.sort_array(F.collect_set(variant)).alias("variants")
    )
    return grouped.where("_any").drop("_any")


def to_listing(rows: DataFrame, scraped_at: Column) -> DataFrame:
    """Listing rows with a made-up URL from the row key, so that imports are idempotent."""
    def some(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(0.0))

    def json(c: Column) -> Column:
        return F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)

    def whole(c: Column) -> Column:
        return F.bround(c, 0).cast("bigint").cast("string")

    attributes = F.create_map(
        F.lit("Land size"), json(F.col("size_text")), F.lit("Size (perches)"), json(F.bround(some("size_perches"), 2)),
        F.lit("Size unit as given"), json(F.col("size_unit")), F.lit("Price basis"), json(F.col("price_basis")),
        F.lit("Price amount"), json(F.col("price_amount")), F.lit("Price per perch"), whole(some("price_per_perch")),
        F.lit("Total price"), whole(some("price_total")), F.lit("Location as listed"), json(F.col("location_listed")),
        F.lit("District source"), json(F.col("district_source")),
        F.lit("Data flags"), json(F.nullif(F.array_join("flags", ", "), F.lit(""))), F.lit("Source table"), json(F.col("source_table")),
    )
    url = F.concat(F.lit("imported:land/"), F.col("row_key"))
    text = F.lit(None).cast("string")
    columns = {
        "listing_id": listing_id(url), "url": url, "title": F.col("title"), "price_text": F.col("price_text"),
        "price_value": F.col("price_total"), "currency": F.when(some("price_amount").isNotNull(), "LKR"),
        "price_qualifier": F.when(F.col("price_basis").isin("perch", "acre"), F.concat(F.lit("per "), F.col("price_basis"))).otherwise(F.col("price_basis")),
        "category": F.lit("Land"), "subcategory": F.lit("Land for sale"), "location_text": F.col("location_listed"),
        "town": F.col("town"), "district": F.col("district"), "is_promoted": F.lit(False),
        "image_urls": F.array().cast("array<string>"),
        "attributes": F.map_filter(attributes, lambda k, v: v.isNotNull() & (v != "null")),
        "source_page": F.lit("markdown-import"), "extracted_by": F.lit("table-import"), "scraped_at": scraped_at,
    }
    return rows.select(*[columns.get(c, text).alias(c) for c in ROW_COLUMNS])


def summary(rows: DataFrame, district: str = dims.DISTRICT) -> DataFrame:
    """(section, key, n): row counts, distinct adverts, districts and flag kinds. Rows are read once."""
    rows = staged(rows.select("row_key", "district", "flags"), "summary")
    one = rows.agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count_distinct("row_key").alias("unique_adverts"),
        F.count_if(F.col("district") == district).alias("in_district"),
    ).withColumn("duplicate_rows", F.col("rows_parsed") - F.col("unique_adverts"))
    names = ["rows_parsed", "unique_adverts", "duplicate_rows", "in_district"]
    totals = one.select(F.explode(F.array(*[F.struct(F.lit("total").alias("section"), F.lit(n).alias("key"), F.col(n).alias("n")) for n in names])).alias("x")).select("x.*")
    by_district = rows.groupBy(F.coalesce(F.nullif("district", F.lit("")), F.lit(dims.UNVERIFIED)).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    by_flag = rows.select(F.explode("flags").alias("f")).groupBy(flag_kind(F.col("f")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return totals.unionByName(by_district.select(F.lit("district").alias("section"), "key", "n")).unionByName(
        by_flag.select(F.lit("flag").alias("section"), "key", "n")
    )


def flagged(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("flags") > 0)
