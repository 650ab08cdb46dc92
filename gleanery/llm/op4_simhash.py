"""SimHash near-dedup by multi-index hashing.

Fingerprints are computed in Arrow batches. Copies collapse into one row a fingerprint.
Two fingerprints within 4 bits agree to within 2 bits in one of their 32-bit halves, so
the Hamming balls of radius 1 around those halves share a value: each fingerprint is
filed under the 33 values of each ball (66 rows) and looks its values up in that table.

* A value with up to ``SMALL`` fingerprints: its pairs are verified over all 64 bits. A
  pair shares up to 66 values; only the first of them that the join can name from the two
  fingerprints alone makes a link, so each link leaves the join once.
* A value with more: its fingerprints are filed under every 64-bit value within 2 bits of
  them (2,081 rows each). Those under one value lie within 4 bits of each other, and any
  two within 4 bits share such a value; a link to the least of them joins them all. So a
  dense group costs rows in proportion to its members, never its pairs.

Links are joined to components by star rounds in the shared folder.

``representatives``, the pipeline's stage, doesn't search fingerprints: its notion of near is a
similarity of whole texts, and it finds every such pair by a prefix filter on their windows.

Defined edge cases
* null text counts as empty; texts without words have fingerprint zero, linked like any other
* null ids: a component's id is its least id that is not null, null if there is none
* copies and repeated rows share fingerprint and component
* empty table: empty result; other columns are ignored
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .lookup import join_counted
from .staging import stage

SHINGLE = 4
BITS = 4
SEED = 42
SMALL = 128
#: Near copies of whole texts (``representatives``): similarity on windows; the rows and buckets that order them.
SIMILARITY = 0.8
SAMPLE = 8
BUCKET_BITS = 20
_ODD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_LOW = 0xFFFFFFFF
_COLUMN = (np.arange(8) * 256).astype(np.int64)
_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingles(text: str | None, size: int) -> list[bytes]:
    """Space-joined windows of ``size`` words, A-Z lower-cased; fewer words are one window."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - size + 1].tolist()
    whole = b" ".join(words)
    return [whole[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def simhash(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned."""
    grams = shingles(text, size)
    if not grams:
        return 0
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(g, SEED) for g in grams]), np.uint8).reshape(-1, 8)
    counts = np.bincount((hashes + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _SET
    return int.from_bytes(np.packbits(2 * counts.ravel() > len(grams)).tobytes(), "big")


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((simhash(t.as_py(), size) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), for every row."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _batches(it, size), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _filed(prints: DataFrame, by: list[str]) -> DataFrame:
    """(key, fp, ``by``): each fingerprint under the radius-1 balls of its two halves."""
    flips = F.array(F.lit(0), *[F.lit(1 << i) for i in range(32)])
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(_LOW))
    ball = F.concat(
        F.transform(flips, lambda m: high.bitwiseXOR(m.cast("long"))),
        F.transform(flips, lambda m: low.bitwiseXOR(m.cast("long")) + F.lit(1 << 32)),
    )
    return prints.select(F.explode(ball).alias("key"), "fp", *by)


def _midpoints(prints: DataFrame, by: list[str]) -> DataFrame:
    """(point, fp, ``by``): each fingerprint under every value within 2 bits of it."""
    ones = [1 << i for i in range(64)]
    masks = [0, *ones, *[a | b for i, a in enumerate(ones) for b in ones[i + 1 :]]]
    table = F.from_json(F.lit(str([_signed(m) for m in masks])), "array<long>")  # one literal, folded by the planner
    return prints.select(F.explode(F.transform(table, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"), "fp", *by)


def _first_shared(u: Column, v: Column) -> Column:
    """The one value at which a pair within 4 bits is linked: of the radius-1 balls around two
    32-bit values at most 2 bits apart, the middle on the way over the lowest differing bit."""

    def middle(a: Column, b: Column) -> Column:
        apart = a.bitwiseXOR(b)
        lowest = apart.bitwiseAND(-apart)
        return F.least(a.bitwiseXOR(lowest), b.bitwiseXOR(lowest))

    high = F.shiftrightunsigned(u, 32), F.shiftrightunsigned(v, 32)
    low = u.bitwiseAND(F.lit(_LOW)), v.bitwiseAND(F.lit(_LOW))
    return F.when(F.bit_count(high[0].bitwiseXOR(high[1])) <= 2, middle(*high)).otherwise(middle(*low) + F.lit(1 << 32))


def links(prints: DataFrame, small: int = SMALL, by: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (u, v, ``by``) of distinct fingerprints within 4 bits that connect all that are. Those
    that differ in a column of ``by`` don't meet."""
    by = list(by)
    # Rows are distinct fingerprints, moved once; values that nothing shares end here.
    counted = _filed(prints, by).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key", *by)))
    members = stage(counted.where("n > 1"), "members")
    few = members.where(F.col("n") <= small)
    a, b = few.select("key", F.col("fp").alias("u"), *by), few.select("key", F.col("fp").alias("v"), *by)
    u, v = F.col("u"), F.col("v")
    # Where the value named is a dense one, both fingerprints are among the members below.
    near = (u > v) & (F.bit_count(u.bitwiseXOR(v)) <= BITS) & (a["key"] == _first_shared(u, v))
    alike = [a[c] == b[c] for c in ("key", *by)]
    direct = a.join(b.hint("merge"), reduce(lambda x, y: x & y, [*alike, near])).select("u", "v", *[a[c] for c in by])
    # No join: the planner takes the points for as few rows as the fingerprints they come from, and would broadcast them.
    points = _midpoints(members.where(F.col("n") > small).select("fp", *by).distinct(), by)
    least = points.withColumn("v", F.min("fp").over(Window.partitionBy("point", *by)))
    starred = least.where("fp != v").select(F.col("fp").alias("u"), "v", *by)
    return direct.unionByName(starred)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, small: int = SMALL) -> DataFrame:
    """One row per document: doc_id, fp, component_id (least id reachable over links)."""
    prints = stage(fingerprints(docs, text, doc_id, size), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "classes")
    roots = components(links(classes.select("fp"), small))
    rooted = stage(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", "n", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = stage(rooted.join(ids, "root").select("fp", "n", "component_id"), "by-print")
    return join_counted(prints, by_print, ["fp"], "n").select("doc_id", "fp", "component_id")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def window_hashes(text: str | None, size: int) -> np.ndarray:
    """The distinct windows of ``size`` words as hashes, sorted; fewer words are one window."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(w, SEED) for w in words], np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    mixed = np.full(count, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + count]) * _ODD
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)


def _bucket_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [window_hashes(t.as_py(), size) for t in batch.column(0)]
        buckets = (np.concatenate(found) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(buckets)], ["b"])


def window_rarity(rows: DataFrame, size: int) -> bytes:
    """One byte for each of ``1 << BUCKET_BITS`` buckets of windows, zlib-compressed: the logarithm of
    its count in one of ``SAMPLE`` rows (key, text). It orders windows; any order finds all pairs, a
    rare one first finds few others."""
    taken = rows.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0).select("text")
    counts = taken.mapInArrow(lambda it: _bucket_batches(it, size), "b long").groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.lit(90), F.floor(F.log2("n") * 3) + 1).cast("int")
    place = (F.col("b") % 1024).cast("int")
    entry = F.concat(F.char(F.expr("33 + (b % 1024) div 32")), F.char(place % 32 + 33), F.char(level + 33)).alias("s")
    grouped = counts.select(F.expr("b div 1024").alias("g"), entry).groupBy("g").agg(F.array_join(F.collect_list("s"), "").alias("s"))
    table = np.zeros(1 << BUCKET_BITS, np.uint8)
    for row in grouped.collect():
        told = np.frombuffer(row["s"].encode("ascii"), np.uint8).reshape(-1, 3).astype(np.int64) - 33
        table[row["g"] * 1024 + told[:, 0] * 32 + told[:, 1]] = told[:, 2]
    return zlib.compress(table.tobytes())


def front_length(n: int, similarity: float) -> int:
    """Two sets this similar share one of the first so many of their ``n`` members, in any one order."""
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def _front_batches(batches: Iterator[pa.RecordBatch], size: int, similarity: float, rarity: bytes) -> Iterator[pa.RecordBatch]:
    """doc_id, key, class (a hash of the words in order), n (windows), front (the rarest of them, in order)."""
    table = np.frombuffer(zlib.decompress(rarity), np.uint8).astype(np.uint64)
    for batch in batches:
        classes, sizes, fronts = [], [], []
        for text in batch.column(1):
            hashes = window_hashes(own := text.as_py(), size)
            tokens = np.unique((table[hashes >> np.uint64(64 - BUCKET_BITS)] << np.uint64(56)) | (hashes >> np.uint64(8))).view(np.int64)
            classes.append(xxhash.xxh64_intdigest(b" ".join(words_of(own)), SEED))
            sizes.append(len(tokens))
            fronts.append(tokens[: front_length(len(tokens), similarity)])
        arrays = [batch.column(0), batch.column(2), pa.array(np.array(classes, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(fronts, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "class", "n", "front"])


def _gram_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """class, grams: the distinct hashes of a text's windows."""
    for batch in batches:
        grams = [window_hashes(t.as_py(), size).view(np.int64) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.list_(pa.int64()))], ["class", "grams"])


def shared_tokens(classes: DataFrame) -> DataFrame:
    """(token, class, n, many): each class under such tokens of its front as ``many`` > 1 classes have."""
    told = classes.select(F.explode("front").alias("token"), "class", "n")
    return told.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("many > 1")


def dense_pairs(shared: DataFrame, similarity: float, small: int = SMALL) -> DataFrame:
    """(u, v): a class of a token that over ``small`` classes have and the first, the last and the one before it (in size) there."""
    own = F.struct("class", "n")
    whole = Window.partitionBy("token")
    others = F.min(own).over(whole), F.max(own).over(whole), F.lag(own).over(whole.orderBy("n", "class"))
    near = shared.where(F.col("many") > small).select("class", "n", F.array(*others).alias("near"))
    met = near.select("class", "n", F.explode("near").alias("x")).where("x.class != class")
    alike = F.least("n", "x.n") >= F.lit(similarity) * F.greatest("n", "x.n") - 1e-9
    return met.where(alike).select(F.greatest("class", "x.class").alias("u"), F.least("class", "x.class").alias("v")).distinct()


def near_pairs(shared: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(u, v): all pairs of classes that may be similar, but for those of one root in ``roots`` (class, root).

    Under each token, the classes of its most frequent root meet only those of others. A pair's
    tokens are counted: of the class whose front ends first, only windows behind its front can be
    shared unseen.
    """
    rooted = shared.select("token", "class", "n").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = stage(rooted, "rooted-tokens")
    per_root = rooted.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n"))
    major = per_root.groupBy("token").agg(F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    told = stage(rooted.join(major.select("token", F.col("most.root").alias("major")).hint("merge"), "token"), "mixed-tokens")
    a, b = told.where("root != major").alias("a"), told.alias("b")
    alike = F.least("a.n", "b.n") >= F.lit(similarity) * F.greatest("a.n", "b.n") - 1e-9
    once = (F.col("b.root") == F.col("b.major")) | (F.col("a.class") > F.col("b.class"))
    met = a.join(b.hint("merge"), (F.col("a.token") == F.col("b.token")) & (F.col("a.root") != F.col("b.root")) & once & alike)
    counted = met.select(F.greatest("a.class", "b.class").alias("u"), F.least("a.class", "b.class").alias("v")).groupBy("u", "v").agg(F.count(F.lit(1)).alias("c"))
    ends = classes.select("class", "n", F.size("front").alias("p"), F.element_at("front", -1).alias("last")).where("n > 0")
    u, v = (ends.select(F.col("class").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("n", "p", "last")]) for c in ("u", "v"))
    unseen = F.when(F.col("u_last") <= F.col("v_last"), F.col("u_n") - F.col("u_p")).otherwise(F.col("v_n") - F.col("v_p"))
    enough = (F.col("c") + unseen) * F.lit(1 + similarity) >= F.lit(similarity) * (F.col("u_n") + F.col("v_n")) - 1e-6
    return stage(counted.join(u.hint("merge"), "u").join(v.hint("merge"), "v").where(enough).select("u", "v"), "near")


def similar_links(near: DataFrame, rows: DataFrame, keys: DataFrame, size: int, similarity: float) -> DataFrame:
    """Of the pairs (u, v) those whose texts have a Jaccard similarity of ``similarity`` on windows of
    ``size`` words. ``rows``: key, text; ``keys``: class and the key of one of its rows."""
    ends = near.select(F.col("u").alias("class")).unionByName(near.select(F.col("v").alias("class"))).distinct()
    wanted = stage(ends.join(keys, "class").select("class", "key"), "ends")
    texts = rows.join(wanted, "key").dropDuplicates(["class"]).select("class", "text")
    grams = stage(texts.mapInArrow(lambda it: _gram_batches(it, size), "class long, grams array<long>"), "grams")
    u, v = (grams.select(F.col("class").alias(c), F.col("grams").alias(f"{c}_grams")) for c in ("u", "v"))
    both = F.size(F.array_intersect("u_grams", "v_grams"))
    either = F.size("u_grams") + F.size("v_grams") - both
    return near.join(u.hint("merge"), "u").join(v.hint("merge"), "v").where(both >= F.lit(similarity) * either - 1e-9).select("u", "v")


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, similarity: float = SIMILARITY,
                    small: int = SMALL) -> DataFrame:
    """``docs`` with one row of each group of near copies: that with the least id, null ids last.

    Near copies have a Jaccard similarity of ``similarity`` or more on windows of ``size`` words. All
    are found, by a prefix filter: similar sets share one of their rarest windows. Windows of over
    ``small`` texts link some of these first, so that the pairs of a large group of near copies need
    not be made; all pairs of what is not linked by then are.

    Rows are told apart by id and text together, so rows without an id, and unlike texts under
    one id, are each judged on their own. Of rows that share both, one is left. Texts without
    words are one group. Copies are combined before they are shuffled.
    """
    parts = [F.coalesce(F.concat(F.lit(mark), F.col(c).cast("string")), F.lit("-")) for mark, c in (("i", doc_id), ("t", text))]
    key = F.sha2(F.concat(parts[0], F.lit(":"), parts[1]), 256)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), key.alias("key"))
    rarity = window_rarity(slim.select("key", "text"), size)
    kinds = "doc_id long, key string, class long, n int, front array<long>"
    found = stage(slim.mapInArrow(lambda it: _front_batches(it, size, similarity, rarity), kinds), "fronts")
    classes = stage(found.groupBy("class").agg(F.min(F.struct("key", "n", "front")).alias("x")).select("class", "x.*"), "classes")
    rows, keys = slim.select("key", "text"), classes.select("class", "key")
    shared = stage(shared_tokens(classes), "shared-tokens")
    dense = stage(dense_pairs(shared, similarity, small), "dense")
    settled = stage(similar_links(dense, rows, keys, size, similarity), "settled")
    roots = stage(components(settled).withColumnRenamed("node", "class"), "roots")
    rest = similar_links(near_pairs(shared, classes, roots, similarity), rows, keys, size, similarity)
    roots = components(settled.unionByName(rest)).withColumnRenamed("node", "class")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    rooted = found.select("doc_id", "key", "class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    stays = rooted.groupBy("root").agg(first.alias("first")).select("first.key")
    rows = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row")).dropDuplicates(["key"])
    return rows.join(stays, "key", "left_semi").select("row.*")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
