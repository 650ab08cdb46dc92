"""Merging repeated observations of a listing: a keyed fold that never blanks a known value.

Observations carry ``seq``, their order of arrival. All columns fold in partial aggregates:
scalars by key, entries of maps and items of lists by key and name, so a key of any number of
observations is combined before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LISTING, ROW_COLUMNS

#: Folded in their own way.
_SPECIAL = {"listing_id", "url", "is_promoted", "scraped_at", "attributes", "image_urls"}


def is_known(c: Column, kind: str) -> Column:
    """Empty texts and zeros say nothing, as nulls do."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind in ("double", "float", "int", "bigint"):
        return c.isNotNull() & (c != 0)
    return c.isNotNull()


def last_known(column: str, kind: str, seq: str = "seq") -> Column:
    """The latest known value, else the first one there was."""
    c = F.col(column)
    return F.coalesce(F.max_by(c, F.when(is_known(c, kind), F.col(seq))), F.min_by(c, F.col(seq)))


def fold_maps(observations: DataFrame, column: str, key: str, seq: str = "seq") -> DataFrame:
    """(key, column): right-biased union of maps, a later value of a name wins. Values meet by
    (key, name), so a key's observations never meet in one place; entries are in the order of
    the values that won."""
    each = observations.select(F.col(key).alias("_k"), F.col(seq).alias("_s"), F.posexplode(F.map_entries(column)).alias("_i", "_e"))
    last = each.groupBy("_k", F.col("_e.key").alias("_n")).agg(F.max(F.struct("_s", "_i")).alias("_at"), F.max_by("_e.value", "_s").alias("_v"))
    rows = F.array_sort(F.collect_list(F.struct("_at", "_n", "_v")))
    return last.groupBy(F.col("_k").alias(key)).agg(F.map_from_entries(F.transform(rows, lambda r: F.struct(r["_n"], r["_v"]))).alias(column))


def fold_lists(observations: DataFrame, column: str, key: str, seq: str = "seq") -> DataFrame:
    """(key, column): union of lists in order of first sight; repeats inside one value stay. Items
    meet by (key, item), nulls are left out."""
    items = F.col(column)

    def places(item: Column) -> Column:
        return F.array_compact(F.transform(items, lambda x, i: F.when(x == item, i)))

    told = F.transform(F.array_compact(F.array_distinct(items)), lambda x: F.struct(x.alias("u"), places(x).alias("at")))
    each = observations.select(F.col(key).alias("_k"), F.col(seq).alias("_s"), F.explode(told).alias("_e"))
    first = each.groupBy("_k", F.col("_e.u").alias("_u")).agg(F.min("_s").alias("_s"), F.min_by("_e.at", "_s").alias("_at"))
    rows = first.select("_k", "_s", F.explode("_at").alias("_i"), "_u")
    ordered = F.array_sort(F.collect_list(F.struct("_s", "_i", "_u")))
    return rows.groupBy(F.col("_k").alias(key)).agg(F.transform(ordered, lambda r: r["_u"]).alias(column))


def fold(observations: DataFrame, key: str = "listing_id", seq: str = "seq") -> DataFrame:
    """One row a key from listings observed in the order of ``seq``. A null key has no maps or lists."""
    kinds = dict(observations.dtypes)
    aggregates = {c: last_known(c, kinds[c], seq) for c in ROW_COLUMNS if c in kinds and c not in _SPECIAL | {key}}
    aggregates |= {"url": last_known("url", "string", seq), "is_promoted": F.max_by("is_promoted", seq), "scraped_at": F.min_by("scraped_at", seq)}
    if "detail_fetched" in kinds:
        aggregates["detail_fetched"] = F.max("detail_fetched")
    plain = observations.groupBy(key).agg(*[c.alias(name) for name, c in aggregates.items()])
    joined = plain.join(fold_maps(observations, "attributes", key, seq), key, "left").join(fold_lists(observations, "image_urls", key, seq), key, "left")
    none = {"attributes": F.create_map().cast("map<string,string>"), "image_urls": F.array().cast("array<string>")}
    joined = joined.withColumns({c: F.coalesce(c, empty) for c, empty in none.items()})
    return joined.select(key, *[c for c in [*ROW_COLUMNS, "detail_fetched"] if c in aggregates or c in none])


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "listing_id") -> DataFrame:
    """The next snapshot: stored rows come first, incoming ones in the order of their ``seq``."""
    first = stored.withColumn("seq", F.lit(-1).cast("long"))
    return fold(first.unionByName(incoming, allowMissingColumns=True), key)


def upsert_counts(stored: DataFrame, incoming: DataFrame, key: str = "listing_id") -> DataFrame:
    """(new, updated): a key seen again inside the batch counts as updated."""
    keys = incoming.select(key).distinct().join(stored.select(key), key, "left_anti")
    new = keys.agg(F.count(F.lit(1)).alias("new"))
    total = incoming.agg(F.count(F.lit(1)).alias("total"))
    return new.crossJoin(total).select("new", (F.col("total") - F.col("new")).alias("updated"))  # one row each


def mark_detail(listings: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """``detail_fetched`` set where ``done`` has the key."""
    marked = listings.join(done.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    return marked.withColumn("detail_fetched", F.greatest("detail_fetched", F.coalesce("_done", F.lit(0)))).select(*listings.columns)


def complete(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Missing listing columns added as nulls, in their order; ``keep`` names further columns to keep."""
    have = set(rows.columns)
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in LISTING.fields]
    return rows.select(*columns, *(keep or []))
