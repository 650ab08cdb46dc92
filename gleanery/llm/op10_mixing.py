"""Mixing sources to target weights, with built-in functions only.

Tokens (words) are summed per source, each source gets a target, the repetition
rate is target / size, and a document is emitted floor(rate) times plus one
Bernoulli copy whose coin is a hash of its id and a seed.

Defined edge cases
* null or blank text: size 0; it still gets its floor(rate) copies, worth 0 words
* null source: a source of its own, ranked last
* sources without a word: target 0, rate 0
* empty table: empty result
* repeated rows with one doc_id flip the same coin, so reruns agree
* other columns, whatever their names, are passed through by ``mix``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import attach
from .staging import stage
from .words import word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = 20


def coin(doc_id: Column, seed: int = SEED) -> Column:
    """Uniform in [0, 1) from 52 bits of an MD5 of seed and id; the same in any SQL engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_ranks(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` (0-based, by code point, null last) without one task holding all sources.

    Range partitions are ranked on their own; the number of partitions, not of
    sources, bounds what the offset window reads.
    """
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stage(
        sources.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "sources"
    )
    local = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("part", "before")
    return local.join(F.broadcast(before), "part").withColumn("rank", F.col("at") + F.col("before")).drop("part", "at", "before")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The water level is found by a few one-row aggregates over the source table:
    each round caps the sources whose share exceeds ``most`` times their size
    and reshares the rest by weight, until no further source is above.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.array(*[F.lit(int(w)) for w in weights])
    ranked = stage(
        source_ranks(sources).withColumn("weight", F.element_at(pick, (F.col("rank") % len(weights) + 1).cast("int"))),
        "ranked",
    )
    cap = F.col("source_size") * F.lit(float(most))
    level = -1.0
    while True:
        free = cap > F.col("weight") * F.lit(level)
        got = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(~free, F.col("source_size"))).alias("capped"),
            F.sum(F.when(free, F.col("weight"))).alias("weights"),
        ).first()
        if not got.weights:  # all are at their caps, or there are no sources
            target = cap
            break
        new = (share * (got.total or 0) - most * (got.capped or 0)) / got.weights
        if new <= level:
            target = F.least(cap, F.col("weight") * F.lit(level))
            break
        level = new
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def with_targets(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Null-safe lookup of (row, source, doc_id) in the targets: adds source_size and target."""
    def key(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("s"), F.col(c)), F.lit("n")).alias("key")

    return attach(rows.select("row", "doc_id", key("source")), table.select(key("source"), "source_size", "target"), ["key"], F.col("doc_id"))


def copies(doc_id: Column, source_size: Column, target: Column, seed: int = SEED) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + F.when(coin(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def plan_mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
             weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies."""
    sized = stage(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")),
        "sized",
    )
    table = targets(sized.select("source", "size"), weights, share, most)
    found = with_targets(sized.select(F.struct("size").alias("row"), "source", "doc_id"), table)
    return found.select(
        "doc_id", "row.size", "source_size", "target", copies(F.col("doc_id"), F.col("source_size"), F.col("target"), seed).alias("copies")
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` repeated as often as it was planned."""
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col(source).cast("string").alias("source"), F.col(doc_id).alias("doc_id"))
    sized = stage(named.select("source", word_count(F.col("row").getField(text)).alias("size")), "sized")
    found = with_targets(named, targets(sized, weights, share, most))
    n = copies(F.col("doc_id"), F.col("source_size"), F.col("target"), seed)
    return found.select("row", F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select("row.*")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return plan_mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM sources),
level AS (
  SELECT max((1.5::DOUBLE * total - 2.0::DOUBLE * capped) / weights) AS water FROM ordered
  WHERE 2.0::DOUBLE * source_size > weight * ((1.5::DOUBLE * total - 2.0::DOUBLE * capped) / weights)),
targets AS (
  SELECT source, source_size,
         CASE WHEN water IS NULL THEN 2.0::DOUBLE * source_size ELSE least(2.0::DOUBLE * source_size, weight * water) END AS target
  FROM sources, level),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / {float(1 << 52)}::DOUBLE AS coin
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
