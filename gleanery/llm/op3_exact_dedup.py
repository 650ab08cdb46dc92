"""Exact dedup over an extendible-hash index on shared files, with built-in functions only.

1. A scan writes slim entries (doc_id, length, 64-bit key, SHA-256) to the shared folder.
2. The directory: starting from one bucket, each bucket of more than ``BUCKET_KEYS`` distinct
   keys is split by its next bit, and the directory doubles whenever a bucket gets deeper than
   it; there is no last depth. Only counters by leading bits reach the driver. From
   ``BUCKETS`` buckets on, buckets hold more keys instead, which bounds the directory.
3. A second scan finds each text's bucket by its slot in the directory and groups by (bucket,
   key, normalised text), which compares the bytes of the texts. Copies are combined before
   the shuffle, so a text that a third of all rows share costs one row a task.
4. Owner tasks hold ranges of (bucket, key). They chain up the texts of each key and write
   the index files, one entry a text, in the order of the keys.
5. The slim entries look up their bucket by slot, and in it their group; rows of groups of
   many copies meet a broadcast of these groups, whose number is counted.

Defined edge cases
* null text counts as empty; empty and blank texts are one group
* ties: most code points, then smallest doc_id (null ids last)
* repeated rows (same id and text) share one verdict and are each counted
* empty table: empty result; other columns are ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import attach, join_counted
from .staging import new_folder, stage
from .words import SPACE, as_text

#: Keys a bucket holds before it is split, and buckets from which on they hold more.
BUCKET_KEYS = 50_000
BUCKETS = 1 << 20
#: Bits counted at a time.
STEP_BITS = 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(as_text(text), SPACE + "+", "")


def prefix(key: Column, bits: int) -> Column:
    """The leading bits of a key as a number; none of them: 0."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def split_buckets(first: int, depth: int, bits: int, counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int]], list[int]]:
    """Split the bucket of the keys that start with ``first`` (``depth`` bits) as far as
    ``counts`` by ``bits`` leading bits tell. Buckets (first, depth) that fit, and the prefixes
    of ``bits`` bits that are overfull still."""
    base = first << (bits - depth)
    sums = [0]
    for slot in range(base, base + (1 << (bits - depth))):
        sums.append(sums[-1] + counts.get(slot, 0))
    fit, full, open_ = [], [], [(first, depth)]
    while open_:
        at, d = open_.pop()
        width = 1 << (bits - d)
        start = (at << (bits - d)) - base
        if sums[start + width] - sums[start] <= capacity or d == 64:
            fit.append((at, d))
        elif d == bits:
            full.append(at)
        else:
            open_ += [(2 * at, d + 1), (2 * at + 1, d + 1)]
    return fit, full


def find_buckets(entries: DataFrame, capacity: int) -> list[tuple[int, int]]:
    """The buckets (first, depth) of the directory, by rounds of counts of ``STEP_BITS`` more bits."""
    spark, keys = entries.sparkSession, entries.select("key").distinct()
    buckets, full, depth, allowed = [], [0], 0, capacity
    while full:
        bits = min(depth + STEP_BITS, 64)
        part = keys
        if depth:  # at most as many prefixes as there are buckets, which are bounded
            of = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in full], "p long")
            part = keys.join(F.broadcast(of), prefix(F.col("key"), depth) == F.col("p"), "left_semi")
        rows = part.groupBy(prefix(F.col("key"), bits).alias("slot")).count().collect()
        counts = {r["slot"] % (1 << 64): r["count"] for r in rows}
        if not depth:
            allowed = max(capacity, -(-sum(counts.values()) // BUCKETS))
        found = [split_buckets(first, depth, bits, counts, allowed) for first in full]
        buckets += [b for fit, _ in found for b in fit]
        full, depth = [x for _, rest in found for x in rest], bits
    return buckets


def build_directory(entries: DataFrame, capacity: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) of every slot, and the number of leading bits that make a slot."""
    buckets = find_buckets(entries, capacity)
    bits = max(depth for _, depth in buckets)
    runs = [(at << (bits - d), ((at + 1) << (bits - d)) - 1, d) for at, d in sorted(buckets)]
    table = entries.sparkSession.createDataFrame(runs, "bucket long, last long, depth int")
    return table.select(F.explode(F.sequence("bucket", "last")).alias("slot"), "bucket", "depth"), bits


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = BUCKET_KEYS):
    """(entries, index). entries: one row a document, with its bucket. index: one row a distinct
    text: bucket, depth, key, sha, n, cp, keep_id."""
    scan = docs.select(F.col(doc_id).cast("long").alias("doc_id"), as_text(F.col(text)).alias("text"))
    scan = scan.select("doc_id", F.length("text").alias("cp"), normalised(F.col("text")).alias("norm"))
    scan = scan.withColumn("key", F.xxhash64("norm"))
    entries = stage(scan.select("doc_id", "cp", "key", F.sha2("norm", 256).alias("sha")), "entries")
    directory, bits = build_directory(entries, capacity)

    def routed(rows: DataFrame) -> DataFrame:
        return attach(rows.withColumn("slot", prefix(F.col("key"), bits)), directory, ["slot"], F.col("key")).where("bucket is not null")

    texts = routed(scan).groupBy("bucket", "depth", "key", "norm", "cp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
    slim = texts.select("bucket", "depth", "key", F.sha2("norm", 256).alias("sha"), F.octet_length("norm").alias("bytes"), "cp", "n", "first_id")
    owned = slim.repartitionByRange("bucket", "key")
    chained = owned.groupBy("bucket", "depth", "key", "sha").agg(
        F.sum("n").alias("n"), F.max(F.struct("cp", F.bitwise_not("first_id").alias("last_id"))).alias("best"),
        F.min("bytes").alias("least"), F.max("bytes").alias("most"),
    )
    # Two texts of one key and one SHA-256 could be told apart here no longer.
    sound = F.when(F.col("least") == F.col("most"), F.col("n")).otherwise(F.raise_error(F.lit("SHA-256 collision")))
    index = chained.select("bucket", "depth", "key", "sha", sound.alias("n"), F.col("best.cp").alias("cp"), F.bitwise_not("best.last_id").alias("keep_id"))
    path = new_folder(docs.sparkSession, "index")
    index.sortWithinPartitions("bucket", "key").write.parquet(path)
    return routed(entries), docs.sparkSession.read.schema(index.schema).parquet(path)


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = BUCKET_KEYS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket."""
    entries, index = build_index(docs, text, doc_id, capacity)
    found = index.select("bucket", "key", "sha", "n", "keep_id", F.col("cp").alias("keep_cp"))
    return join_counted(entries, found, ["bucket", "key", "sha"], "n").select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("cp") == F.col("keep_cp"))).alias("kept"),
        F.col("sha").alias("text_sha256"), "bucket",
    )


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs).drop("bucket")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT doc_id, sha256(norm) AS text_sha256, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
