"""Line dedup as an exact set-similarity join, with built-in functions only.

A line's tokens are its distinct words. A line goes if an earlier line, in the order of
(doc_id, text hash, line number), kept or not, has a Jaccard similarity of 0.8 or more with it.

1. Equal lines are one class; only its first place is looked at further. A document carries
   one byte a line (a mask) of its first places, and is staged once, bucketed by document.
   Every later step reads its words there, so that texts are shuffled once in all.
2. Rarity: tokens are counted in hashed buckets, ``BUCKET_BITS`` bits of them; a token's level is the
   logarithm of its bucket's count. Tokens are ordered by (level, hash), rarest first.
3. Prefix filter: similar sets share one of their first n - ceil(0.8 n) + 1 tokens, that of
   the smaller set among its first n - ceil(8/9 n) + 1. Length and positional filters sit in
   the join condition, and so does a bound from 128 parity bits of each set: sets differ by
   at least as many tokens as their bits do, and similar ones by at most (n + m) / 9.
4. Variants of one line are settled first: in the group of each of its ``HEAD`` rarest tokens
   a line meets the group's first line and the two lines before it. Groups of frequent
   tokens are split by a salt, so rows are in proportion to the lines. Lines that have no
   similar line there probe all the prefixes, in ``SLICES`` slices of tokens; so pairs of two
   settled lines are never made.
5. Jaccard is verified on the words themselves.

Defined edge cases
* null text has no lines and stays null; empty texts stay empty
* lines without words always stay
* null ids come last in the order; of rows that repeat an id and text one counts as the first,
  the lines of the others repeat its lines and go
* a text of any number of lines costs time in proportion to it: line masks are looked up by
  position; a line of any length is one set
* empty table: empty result; other columns, whatever their names, are passed through
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage, stage_bucketed, unstage
from .words import SPACE

#: Similarity as a fraction, 4 / 5.
NUM, DEN = 4, 5
BUCKET_BITS = 20
SLICES = 2
HEAD = 6
#: Groups of tokens this frequent, as a power of two, are split where variants are settled.
GROUP_BITS = 12
_GROUP = 1 << 10
_HASH_BITS = 56
_NO_ID = (1 << 63) - 1
_HALF = 40  # the token bit that says in which half of the parity bits a token counts
_PLACE = ["id", "th", "line"]
_DOC = ["id", "th"]


def _keys(docs: DataFrame, text: str, doc_id: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("th")


def _lines(texts: DataFrame) -> DataFrame:
    """The rows with ``text`` split: line (from 0) and raw, of the lines with words."""
    others = [c for c in texts.columns if c != "text"]
    return texts.select(*others, F.posexplode(F.split("text", "\n")).alias("line", "raw")).where(F.col("raw").rlike(r"[^\x20\x09-\x0D]"))


def mask_of(numbers: Column) -> Column:
    """A sorted array of distinct line numbers as text: "1" at these places, "0" between."""
    gap = F.transform(numbers, lambda n, i: F.concat(F.repeat(F.lit("0"), F.when(i > 0, n - F.get(numbers, i - 1) - 1).otherwise(n)), F.lit("1")))
    return F.array_join(gap, "")


def _marked(mask: Column, line: Column) -> Column:
    """Whether a line is marked in a mask (binary); at once, wherever the line is."""
    return F.substring(mask, line + 1, F.lit(1)) == F.lit(b"1")


def _masks(places: DataFrame, name: str) -> DataFrame:
    """(id, th, ``name``): the line numbers of each document's places as a mask, no places: no row."""
    # Sorted in a step of its own: the mask asks for the numbers again at each of them.
    numbers = places.groupBy(*_DOC).agg(F.sort_array(F.collect_set("line")).alias("numbers"))
    return numbers.select(*_DOC, mask_of(F.col("numbers")).cast("binary").alias(name))


def first_places(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(id, th, line): the first place of every distinct line with words."""
    id_, th = _keys(docs, text, doc_id)
    found = _lines(docs.select(id_, th, F.col(text).cast("string").alias("text")).where("text is not null"))
    least = found.groupBy(F.xxhash64("raw").alias("c1"), F.xxhash64(F.lit(1), "raw").alias("c2")).agg(F.min(F.struct(*_PLACE)).alias("first"))
    return least.select("first.*")


def staged_documents(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(row, id, th, firsts) bucketed by document: each row as a struct, and the mask of the
    lines that are the first of their class; of rows that repeat an id and a text one has it."""
    id_, th = _keys(docs, text, doc_id)
    rows = docs.select(F.struct(*docs.columns).alias("row"), id_, th)
    joined = rows.join(_masks(first_places(docs, text, doc_id), "firsts"), _DOC, "left")
    nth = F.row_number().over(Window.partitionBy(*_DOC).orderBy(*_DOC))  # the join has dealt and sorted the rows so
    led = joined.withColumn("nth", nth).withColumn("firsts", F.when(F.col("nth") == 1, F.col("firsts"))).drop("nth")
    return stage_bucketed(led, "line-documents", _DOC)


def _words(raw: Column) -> Column:
    """A line's words with one space between two; most lines are written that way already."""
    trimmed = F.btrim(raw, F.lit(" \t\n\v\f\r"))
    odd = reduce(lambda a, b: a | b, [raw.contains(c) for c in ("  ", "\t", "\r", "\v", "\f")])
    return F.when(odd, F.regexp_replace(trimmed, SPACE + "+", " ")).otherwise(F.btrim(raw, F.lit(" ")))


def class_lines(staged: DataFrame, text: str, keep: Column | None = None, marks: str = "firsts") -> DataFrame:
    """(id, th, line, words) of the lines marked, one place a class."""
    own = F.col("row").getField(text).cast("string").alias("text")
    marked = staged.where(F.col(marks).isNotNull()).select(*_DOC, marks, own)
    found = _lines(marked).where(_marked(F.col(marks), F.col("line")))
    return found.select(*_PLACE, _words(F.col("raw")).alias("words"))


def _hash(word: Column) -> Column:
    return F.xxhash64(word)


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BUCKET_BITS)


def rarity(classes: DataFrame) -> bytes:
    """One byte a bucket: the level of its count. ``1 << BUCKET_BITS`` bytes, whatever the input."""
    spark = classes.sparkSession
    ones = classes.select(F.explode(F.split("words", " ")).alias("w")).select(_bucket(_hash(F.col("w"))).alias("b"), F.lit(1).cast("long").alias("n"))
    none = spark.range(1 << BUCKET_BITS).select(F.col("id").alias("b"), F.lit(0).cast("long").alias("n"))
    counts = ones.unionByName(none).groupBy("b").agg(F.sum("n").alias("n"))
    level = F.least(F.lit(90), F.floor(F.log2(F.col("n") + 1) * 3)).cast("int")
    grouped = counts.groupBy(F.expr(f"b div {_GROUP}").alias("g")).agg(F.sort_array(F.collect_list(F.struct("b", level.alias("v")))).alias("vs"))
    rows = grouped.select("g", F.array_join(F.transform("vs", lambda x: F.char(x["v"] + 33)), "").alias("s")).collect()
    return "".join(r["s"] for r in sorted(rows, key=lambda r: r["g"])).encode("ascii")


def fronts(classes: DataFrame, levels: bytes) -> DataFrame:
    """(uid, id, th, line, n, front, s, e): of each class its rarest tokens, rarest first; s has
    the parity bits of all its tokens, e those of the half of tokens with bit ``_HALF`` set."""
    # Positions count from 1, and 0 is the first one too: bucket b is read at position b, the first bucket as the second.
    table = F.lit(levels[1:])

    def token(h: Column) -> Column:
        level = F.ascii(F.substring(table, _bucket(h).cast("int"), F.lit(1)).cast("string")).cast("long")
        return F.shiftleft(level, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    def shift(bit: Column, by: Column) -> Column:
        return F.call_function("shiftleft", bit, by.bitwiseAND(F.lit(63).cast("long")).cast("int"))

    one = F.lit(1).cast("long")
    distinct = F.array_distinct(F.transform(F.split("words", " "), _hash))
    ordered = classes.select(*_PLACE, F.sort_array(F.transform(distinct, token)).alias("ordered"))
    n = F.size("ordered")
    length = n - F.ceil(n * F.lit(NUM) / F.lit(DEN)).cast("int") + 1
    s = F.aggregate("ordered", F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(shift(one, t)))
    e = F.aggregate("ordered", F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(shift(F.shiftrightunsigned(t, _HALF).bitwiseAND(one), t)))
    return ordered.select(
        F.monotonically_increasing_id().alias("uid"), *_PLACE, n.alias("n"), F.slice("ordered", F.lit(1), length).alias("front"), s.alias("s"), e.alias("e")
    )


def _alike(n: Column, s: Column, e: Column, m: Column, s2: Column, e2: Column) -> Column:
    """Length filter and parity bound: similar sets differ by at most (n + m) / 9 tokens."""
    both, half = s.bitwiseXOR(s2), e.bitwiseXOR(e2)
    differ = F.bit_count(half) + F.bit_count(both.bitwiseXOR(half))
    return (m * DEN >= n * NUM) & (n * DEN >= m * NUM) & (differ * (NUM + DEN) <= (n + m) * (DEN - NUM))


def _variants(table: DataFrame) -> DataFrame:
    """(uid, uid2): lines and such earlier ones of their tokens' groups as may be similar."""
    me = F.struct("id", "uid", "n", "s", "e")
    head = table.select("id", "uid", "n", "s", "e", F.explode(F.slice("front", 1, HEAD)).alias("token"))
    bits = F.greatest(F.lit(0), F.shiftrightunsigned("token", _HASH_BITS) / 3 - 11 - GROUP_BITS).cast("int")  # levels count thirds from 33
    salted = head.withColumn("salt", F.pmod(F.xxhash64("uid"), F.call_function("shiftleft", F.lit(1).cast("long"), bits)))
    near = Window.partitionBy("token", "salt").orderBy("id", "uid")
    met = salted.select("id", "uid", "n", "s", "e", F.first(me).over(near).alias("a"), F.lag(me, 1).over(near).alias("b"), F.lag(me, 2).over(near).alias("c"))
    able = F.filter(
        F.array("a", "b", "c"),
        lambda x: x.isNotNull() & (x["uid"] != F.col("uid")) & _alike(F.col("n"), F.col("s"), F.col("e"), x["n"], x["s"], x["e"]),
    )
    return met.select("uid", F.explode(able).alias("x")).select("uid", F.col("x.uid").alias("uid2")).distinct()


def _verified(pairs: DataFrame, table: DataFrame, staged: DataFrame, text: str) -> DataFrame:
    """(id, th, line) of the lines whose pair (uid, uid2) is similar, the other one earlier."""
    ends = pairs.select("uid").unionByName(pairs.select(F.col("uid2").alias("uid"))).distinct()
    places = stage(table.select("uid", *_PLACE).join(ends.hint("shuffle_hash"), "uid"), "ends")
    wanted = staged.join(_masks(places, "wanted").hint("shuffle_hash"), _DOC)
    words = stage(class_lines(wanted, text, marks="wanted").join(places, _PLACE).select("uid", *_PLACE, "words"), "end-words")
    a = words.select("uid", F.struct(*_PLACE).alias("p"), F.split("words", " ").alias("a"))
    b = words.select(F.col("uid").alias("uid2"), F.struct(*_PLACE).alias("p2"), F.split("words", " ").alias("b"))
    x, y = F.array_distinct("a"), F.array_distinct("b")
    similar = F.size(F.array_intersect(x, y)) * (NUM + DEN) >= (F.size(x) + F.size(y)) * NUM
    found = pairs.join(a, "uid").join(b, "uid2").where((F.col("p2") < F.col("p")) & similar)
    out = stage(found.select("p.*").distinct(), "similar")
    unstage(places)
    unstage(words)
    return out


def similar_lines(staged: DataFrame, text: str) -> DataFrame:
    """(id, th, line) of the classes that have a similar class with an earlier first place."""
    classes = class_lines(staged, text)
    table = stage_bucketed(fronts(classes, rarity(classes)), "fronts", _DOC)
    # 1. variants of one line
    near = stage(_variants(table), "variants")
    settled = _verified(near, table, staged, text)
    unstage(near)
    # 2. every other class against all earlier ones that share a prefix token
    marks = _masks(settled, "done").hint("shuffle_hash")
    done = F.when(F.col("done").isNull(), F.lit(False)).otherwise(_marked(F.col("done"), F.col("line")))
    open_ = table.join(marks, _DOC, "left").select("id", "uid", "n", "front", "s", "e", F.when(done, 0).otherwise(1).alias("open"))
    parts = []
    for part in range(SLICES):
        rows = open_.select("id", "uid", "n", "s", "e", "open", F.posexplode("front").alias("i0", "token")).where(F.pmod("token", F.lit(SLICES)) == part)
        rows = rows.select("token", "id", "uid", "n", "s", "e", (F.col("i0") * 2 + F.col("open")).alias("io"))
        a, b = rows.alias("a"), rows.alias("b")
        n, m = F.col("a.n"), F.col("b.n")
        i, j = F.expr("shiftright(a.io, 1) + 1"), F.expr("shiftright(b.io, 1) + 1")
        least = F.ceil(F.least(n, m) * F.lit(2 * NUM) / F.lit(NUM + DEN)).cast("int")  # the overlap that sets of the smaller size need
        close = (
            # Whether a is open is asked in one term with b, so that both sides read one exchange.
            (F.col("a.token") == F.col("b.token")) & (F.expr("(a.io & 1) + (b.io & 0)") == 1)
            & (F.col("b.id") <= F.col("a.id")) & (F.col("a.uid") != F.col("b.uid"))
            & ((F.least(n - i, m - j) + 1) * (NUM + DEN) >= (n + m) * NUM)
            & (F.when(n <= m, i).otherwise(j) <= F.least(n, m) - least + 1)
            & _alike(n, F.col("a.s"), F.col("a.e"), m, F.col("b.s"), F.col("b.e"))
        )
        parts.append(stage(a.join(b, close).select("a.uid", F.col("b.uid").alias("uid2")), "candidates"))
    rest = _verified(reduce(DataFrame.unionByName, parts).distinct(), table, staged, text)
    for part in (*parts, table):
        unstage(part)
    return settled.unionByName(rest)


def deduped(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(row, lines, removed): each row of ``docs`` as a struct, its text without repeated
    lines, and how many lines it had and lost. Nothing can clash with names inside the row."""
    staged = staged_documents(docs, text, doc_id)
    doubled = _masks(similar_lines(staged, text), "doubled").hint("shuffle_hash")
    joined = staged.join(doubled, _DOC, "left")
    own = F.col("row").getField(text).cast("string")
    raw = F.split(own, "\n")

    def stays(line: Column, i: Column) -> Column:
        first = F.coalesce(_marked(F.col("firsts"), i), F.lit(False)) & ~F.coalesce(_marked(F.col("doubled"), i), F.lit(False))
        return first | ~line.rlike(r"[^\x20\x09-\x0D]")

    kept = joined.select("row", F.filter(raw, stays).alias("kept"), F.size(raw).alias("n"))
    gone = F.when(own.isNull(), 0).otherwise(F.col("n") - F.size("kept"))
    new = F.col("row").withField(text, F.when(gone == 0, own).otherwise(F.array_join("kept", "\n")))
    return kept.select(new.alias("row"), F.when(own.isNull(), 0).otherwise(F.col("n")).cast("long").alias("lines"), gone.cast("long").alias("removed"))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with repeated lines removed from ``text``."""
    return deduped(docs, text, doc_id).select("row.*")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduped(docs).select("row.doc_id", "row.text", F.col("lines").alias("n_lines"), F.col("removed").alias("n_removed"))
