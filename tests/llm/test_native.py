"""Mixing, exact dedup and line dedup against SQL or brute force, and their edge cases."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.llm import lookup, op3_exact_dedup, op6_line_dedup, op10_mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("module", [op10_mixing, op3_exact_dedup])
def test_against_sql(spark, sf_dir, same, module):
    same(module.query(spark, sf_dir), module.ORACLE)


ODD = [
    (1, "a b  c", "s"), (2, "a b c ", "s"), (2, "a b c ", "s"), (None, "abc", None), (4, None, None), (5, "", "t"), (6, " \t\n", "t"), (7, "x" * 50_000, "hot"),
    (8, "one two three four five\none two three four five\n\none two three four six", "hot"), (9, "one two three four five seven\nother", "hot"),
]
KINDS = "doc_id long, text string, source string"


@pytest.fixture
def odd(spark):
    # names that operators might use inside, and a column of another type under a common name
    return spark.createDataFrame(ODD, KINDS).withColumns({c: F.lit("own") for c in ("size", "key", "rank", "id", "row", "n", "place", "target")})


def keep_of(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    return {k: (min(v)[2], len(v)) for k, v in groups.items()}


def test_exact_dedup_of_odd_rows(odd):
    want = keep_of(ODD)
    got = op3_exact_dedup.classes(odd, capacity=1).collect()
    assert len(got) == len(ODD)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert all(by_sha[r["text_sha256"]] == (r["keep_id"], r["group_size"]) for r in got)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got if r["doc_id"] not in (None,))


def test_hot_groups_are_joined_apart(odd, monkeypatch):
    def found():
        return sorted(map(str, op3_exact_dedup.classes(odd, capacity=2).collect()))

    whole = found()
    monkeypatch.setattr(lookup, "HOT", 1)
    assert found() == whole


def test_buckets_split_until_they_fit():
    counts = {0: 5, 1: 5, 2: 1, 0xFF: 9}
    fit, full = op3_exact_dedup.split_buckets(0, 0, 8, counts, 5)
    assert full == [0xFF]  # nine keys share eight bits: counted by more bits in the next round
    covered = sorted((at << (8 - d), ((at + 1) << (8 - d)) - 1) for at, d in [*fit, (0xFF, 8)])
    assert covered[0][0] == 0 and covered[-1][1] == 255 and all(a[1] + 1 == b[0] for a, b in zip(covered, covered[1:], strict=False))
    assert all(sum(n for k, n in counts.items() if a <= k <= b) <= 5 for a, b in covered[:-1])
    assert (0, 8) in fit and (1, 8) in fit and (1, 7) in fit


def test_directory_grows_with_the_keys(spark):
    """More rounds than one, no fixed last depth: buckets of one key each."""
    near = [(5 << 40) + i for i in range(6)] + [-1, 7]  # keys that share up to 61 bits
    entries = spark.createDataFrame([(k,) for k in near + near[:2]], "key long")
    buckets = op3_exact_dedup.find_buckets(entries, 1)
    assert max(d for _, d in buckets) == 64
    for k in near:
        assert sum((k % (1 << 64)) >> (64 - d) == at for at, d in buckets) == 1
    assert sum(1 << (64 - d) for _, d in buckets) == 1 << 64


def test_rows_are_found_through_the_directory(odd, monkeypatch):
    build = op3_exact_dedup.build_directory
    whole = op3_exact_dedup.classes(odd, capacity=1).collect()
    assert len({r["bucket"] for r in whole}) > 2

    def without_one(entries, capacity):
        table, bits = build(entries, capacity)
        return table.where(F.col("bucket") != whole[0]["bucket"]), bits

    monkeypatch.setattr(op3_exact_dedup, "build_directory", without_one)
    left = op3_exact_dedup.classes(odd, capacity=1).collect()
    assert len(left) == sum(r["bucket"] != whole[0]["bucket"] for r in whole) < len(whole)


def test_mixing_odd_rows(odd):
    out = op10_mixing.plan_mix(odd).collect()
    assert len(out) == len(ODD)
    sizes = defaultdict(int)
    for _, t, s in ODD:
        sizes[s] += len(WORD.findall(t or ""))
    assert all(0 <= r["copies"] <= 2 and r["source_size"] in sizes.values() for r in out)
    assert op10_mixing.mix(odd).columns == odd.columns


def test_targets_by_hand(spark):
    # weights by order: a 5, b 2, c 1, null 5; 1.5 * 1000 = 1500 words to share
    rows = [("b", 300), ("a", 100), ("c", 500), (None, 100)]
    got = {r["source"]: r["target"] for r in op10_mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    # a and null stop at 200; b and c share 1100 by 2 to 1, b stops at 600, c gets the rest
    assert got == {"a": 200.0, None: 200.0, "b": 600.0, "c": 500.0}


def test_salted_lookup_is_the_same(odd, monkeypatch):
    def plan():
        return sorted(map(str, op10_mixing.plan_mix(odd).collect()))

    broadcast = plan()
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    assert plan() == broadcast


def test_mixing_comes_near_its_targets(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("source"))
    rows = op10_mixing.plan_mix(docs)
    by = rows.groupBy("source_size", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
    assert rows.selectExpr("max(copies)").first()[0] <= 2
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in by.collect())
    assert op10_mixing.mix(docs).count() == rows.agg(F.sum("copies")).first()[0]


def brute_lines(rows):
    return dict(brute_rows(rows))


def brute_rows(rows):
    seen, out = [], []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        kept = []
        for line in (text or "").split("\n"):
            words = frozenset(WORD.findall(line))
            if not words:
                kept.append(line)
                continue
            if not any(5 * len(words & s) >= 4 * len(words | s) for s in seen):
                kept.append(line)
            seen.append(words)
        out.append((i, "\n".join(kept) if text is not None else None))
    return out


def test_line_dedup_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r["doc_id"]: r["text"] for r in op6_line_dedup.dedup(spark.createDataFrame(rows, docs.schema)).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_of_odd_rows(odd):
    out = op6_line_dedup.dedup(odd)
    assert out.columns == odd.columns
    want = brute_rows([(i, t) for i, t, _ in ODD])  # one of two equal rows loses its line
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in out.collect())


def test_many_equal_rows_are_one(spark):
    rows = [(7, "one two three four five six\nseven eight nine ten")] * 3000 + [(9, "one two three four five six")]
    got = op6_line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("text != ''").collect()
    assert [tuple(r) for r in got] == [rows[0]]


def test_variants_of_one_line_fall_to_the_first(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join([*words[: i % 40], f"new{i}", *words[i % 40 + 1 :]])) for i in range(300)]
    got = op6_line_dedup.deduped(spark.createDataFrame(rows, "doc_id long, text string")).where("removed = 0").collect()
    assert [r["row"]["doc_id"] for r in got] == [0]


def line_rows(spark, rows):
    return {r["doc_id"]: r["text"] for r in op6_line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_a_common_line_and_its_variants(spark):
    import random

    rng = random.Random(9)
    words = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(400):
        own = list(words)
        for k in rng.sample(range(30), rng.choice([0, 1, 2, 3, 5, 8])):
            own[k] = rng.choice(["x", "y", f"new{i}"])
        shared = "the same line stands in every document" if i % 3 else "the  same line stands in every document "
        rows.append((i, f"{shared}\n{' '.join(own)}\n{' '.join(words[:10 + i % 20])}"))
    assert line_rows(spark, rows) == brute_lines(rows)


def test_a_text_of_many_lines(spark):
    rows = [(1, "\n".join(f"line {i % 6000} of {i % 6000} and {i % 7}" for i in range(20_000))), (2, "line 5 of 5 and 5\n\nlast " + "word " * 30_000)]
    got = line_rows(spark, rows)
    # one word of five is the number that tells two lines apart, so equal sets and equal lines only are similar
    seen, kept = set(), []
    for line in rows[0][1].split("\n"):
        words = frozenset(line.split())
        if words not in seen:
            kept.append(line)
        seen.add(words)
    assert len(got[1].split("\n")) <= len(kept) and got[1].split("\n")[0] == kept[0] and got[2].startswith("\nlast word")


def test_prefixes_hold_the_rarest_words(spark):
    from collections import Counter

    lines = [" ".join(["common", "often", f"pair{i // 2}", f"own{i}", *[f"some{i // 40}-{k}" for k in range(6)]]) for i in range(400)]
    rows = spark.createDataFrame([(i, 0, 0, t) for i, t in enumerate(lines)], "id long, th long, line int, words string")
    found = op6_line_dedup.fronts(rows, op6_line_dedup.rarity(rows)).select("id", "n", "front").collect()
    words = {w: n for w, n in Counter(w for t in lines for w in t.split()).items()}
    hashes = {h: w for w, h in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.shiftrightunsigned(F.xxhash64("w"), 8)).collect()}
    for r in found:
        front = [hashes[t & ((1 << 56) - 1)] for t in r["front"]]
        # three of ten words; a few words share the bucket of a more frequent one
        assert r["n"] == 10 and len(front) == 3 and "common" not in front and "often" not in front
    assert sum(f"own{r['id']}" in {hashes[t & ((1 << 56) - 1)] for t in r["front"]} for r in found) > 395


def test_nothing_is_left_in_the_catalog(spark, odd):
    op6_line_dedup.dedup(odd).count()
    assert not [t.name for t in spark.catalog.listTables() if "gleanery" in t.name]


@pytest.mark.parametrize("run", [op3_exact_dedup.classes, op10_mixing.plan_mix, op10_mixing.mix, op6_line_dedup.dedup])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], KINDS)).count() == 0
