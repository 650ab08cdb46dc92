"""Lookups of rows in dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dimension of up to this many rows becomes a literal of the plan.
MOST_LITERALS = 10_000
#: Characters by which the names of a larger one are found.
GRAM = 4


def longest_named(text: Column, names: list[str]) -> Column:
    """The longest of ``names`` inside a text, then the first listed; null if there is none."""
    ordered = sorted(range(len(names)), key=lambda i: -len(names[i]))
    return F.get(F.filter(F.array(*[F.lit(names[i]) for i in ordered]), lambda n: F.contains(text, n)), F.lit(0))


def theta_lookup(rows: DataFrame, text: str, dimension: DataFrame, name: str, order: str) -> DataFrame:
    """Left outer theta join, top 1: adds ``found``, the longest name of the dimension in ``text``,
    then the first by ``order``. Empty names are none.

    Small dimensions (their size is checked) become a literal that a row is tested against
    without a shuffle; larger ones are joined by ``indexed_lookup``.
    """
    named = dimension.where(F.col(name) != "")
    found = named.orderBy(order).select(name).limit(MOST_LITERALS + 1).collect()
    if len(found) > MOST_LITERALS:
        return indexed_lookup(rows, text, named, name, order)
    return rows.withColumn("found", longest_named(F.col(text), [r[0] for r in found]) if found else F.lit(None).cast("string"))


def indexed_lookup(rows: DataFrame, text: str, dimension: DataFrame, name: str, order: str) -> DataFrame:
    """``theta_lookup`` for a dimension of any size: a name is filed under its first ``GRAM``
    characters (a shorter one under all), a text looks up the runs of characters it has, and
    whole names are verified. Distinct texts are looked up once."""
    names = dimension.groupBy(F.col(name).alias("_n")).agg(F.min(order).alias("_o")).withColumn("_g", F.substring("_n", 1, GRAM))
    texts = rows.select(F.col(text).alias("_t")).where("_t is not null").distinct()
    runs = F.concat(*[F.regexp_extract_all("_t", F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)) for k in range(1, GRAM + 1)])
    hits = texts.select("_t", F.explode(F.array_distinct(runs)).alias("_g")).join(names, "_g").where(F.contains("_t", "_n"))
    best = hits.groupBy("_t").agg(F.min(F.struct((-F.length("_n")).alias("l"), "_o", "_n")).alias("_x"))
    return rows.join(best, F.col(text) == F.col("_t"), "left").withColumn("found", F.col("_x._n")).drop("_t", "_x")


def equi_lookup(rows: DataFrame, key: Column, table: dict[str, str], into: str, default: Column | None = None) -> DataFrame:
    """Left outer lookup in a literal table."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    value = F.try_element_at(pairs, key)
    return rows.withColumn(into, value if default is None else F.coalesce(value, default))
