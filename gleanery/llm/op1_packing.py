"""Best-fit packing after a Martello-Toth dominance reduction.

Piece lengths are whole numbers up to the capacity, so the instance is a histogram of
at most ``capacity`` counters, whatever the corpus. The driver solves that histogram:

* reduction: for the largest open length j it fixes {j}, {j, k} or {j, k, b} wherever
  such a set dominates every other feasible set with j (nothing fits; k fills the rest
  exactly; one more fits at most; two more fit at most and k, b are at least as large,
  item by item, as any other pair), in bulk, until no length gives way;
* the remainder goes by best fit, longest first, on groups of equal bins.

What comes back are patterns with multiplicities: no more than 4 * capacity patterns of
at most 63 distinct lengths for a capacity of 2048, hence a bounded table. A piece finds
its bin by its rank among the pieces of its length: the rank inside its task's chunk
plus the chunk's offset. No task ever holds all pieces of a length.

Defined edge cases
* null text counts as empty; it packs as the single end id
* strings of the vocabulary's added tokens in a text are these tokens
* documents of equal length are told apart by chunk and rank only; repeated rows are
  packed as often as they come
* empty table: empty result; other columns are ignored
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vocab
from .staging import stage

CAPACITY = 2048
END_ID = 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, chunk int, rank long"
_EMIT_ROWS = 50_000


def cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full ones, after a first that may be shorter."""
    if n <= capacity:
        return [n]
    rest = n % capacity
    return [rest] * (rest > 0) + [capacity] * (n // capacity)


def _piece_batches(batches: Iterator[pa.RecordBatch], path: str, capacity: int) -> Iterator[pa.RecordBatch]:
    coder = vocab.byte_bpe(path)
    chunk = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("chunk", pa.int32()), ("rank", pa.int64())])
    end = np.array([END_ID], "<u4")
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        rows.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.concatenate([vocab.encode_whole(coder, text.as_py() or "").astype("<u4", copy=False), end])
            start = 0
            for i, length in enumerate(cut(len(ids), capacity)):
                crc = zlib.crc32(ids[start : start + length].tobytes())
                rows.append((doc_id, i, start, length, crc, chunk, int(seen[length])))
                seen[length] += 1
                start += length
            if len(rows) >= _EMIT_ROWS:
                yield out()
    if rows:
        yield out()


def pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Every piece of every document, with the rank it has in its chunk among its length."""
    path = vocabulary or vocab.byte_bpe_path()
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _piece_batches(it, path, capacity), _PIECES)


class Instance:
    """Counts by length, with the open lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.open = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            del self.open[bisect_left(self.open, size)]

    def largest(self, room: int, without: dict[int, int]) -> int | None:
        """The largest length up to ``room`` that is left besides ``without``."""
        at = bisect_right(self.open, room) - 1
        while at >= 0 and self.n[self.open[at]] <= without.get(self.open[at], 0):
            at -= 1
        return self.open[at] if at >= 0 else None

    def smallest(self, k: int, without: dict[int, int]) -> list[int]:
        out: list[int] = []
        for s in self.open:
            out += [s] * min(k - len(out), self.n[s] - without.get(s, 0))
            if len(out) >= k:
                break
        return out


def _dominating(left: Instance, j: int, capacity: int) -> list[int] | None:
    """Lengths that, with one j, dominate every feasible set with j; None if none is proved."""
    room, own = capacity - j, {j: 1}
    k = left.largest(room, own)
    if k is None:
        return []
    low = left.smallest(3, own)
    if k == room or sum(low[:2]) > room or len(low) < 2:
        return [k]
    if len(low) == 3 and sum(low) <= room:
        return None
    used = {j: 1}
    used[k] = used.get(k, 0) + 1
    b = left.largest(room - k, used)
    y = left.largest(room // 2, own)  # no pair has a larger smaller part
    if b is not None:
        return [k, b] if y is None or y <= b else None
    # k stands alone; it dominates if no pair sums to more than it does
    return [k] if y is None or _best_pair(left, room, own) <= k else None


def _best_pair(left: Instance, room: int, own: dict[int, int]) -> int:
    best = 0
    for a in left.open:
        if 2 * a > room:
            break
        if left.n[a] > own.get(a, 0):
            b = left.largest(room - a, own | {a: own.get(a, 0) + 1})
            best = max(best, a + b if b is not None and b >= a else 0)
    return best


def reduce_by_dominance(left: Instance, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Fixes dominating sets in ``left`` and returns them as (multiplicity, {length: count})."""
    fixed = []
    changed = True
    while changed:
        changed = False
        for j in sorted(left.open, reverse=True):
            while j in left.n and (found := _dominating(left, j, capacity)) is not None:
                pattern: dict[int, int] = {}
                for s in [j, *found]:
                    pattern[s] = pattern.get(s, 0) + 1
                times = min(left.n[s] // c for s, c in pattern.items())
                for s, c in pattern.items():
                    left.take(s, times * c)
                fixed.append((times, pattern))
                changed = True
    return fixed


def best_fit(left: Instance, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, on groups of bins with equal contents."""
    groups: dict[int, list[list]] = {}  # room -> [[bins, pattern], ...]
    rooms: list[int] = []

    def put(bins: int, room: int, pattern: dict[int, int]) -> None:
        if bins:
            if room not in groups:
                groups[room] = []
                rooms.insert(bisect_left(rooms, room), room)
            groups[room].append([bins, pattern])

    for s in sorted(left.open, reverse=True):
        rest = left.n[s]
        while rest:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                bins, pattern = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, pattern = capacity, {}
                bins = -(-rest // (capacity // s))
            each = room // s
            full = min(bins, rest // each)
            some = (rest - full * each) if full < bins else 0
            put(full, room - each * s, pattern | {s: each})
            put(1 if some else 0, room - some * s, pattern | {s: some})
            put(bins - full - (1 if some else 0), room, pattern)
            rest -= full * each + some
    return [(bins, pattern) for found in groups.values() for bins, pattern in found]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Patterns (multiplicity, {length: count}) that hold every piece exactly once."""
    left = Instance(counts)
    fixed = reduce_by_dominance(left, capacity)
    return fixed + best_fit(left, capacity)


def placements(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, rank after the last, first bin, pieces a bin, offset)."""
    rows, ranks, base = [], {}, 0
    for bins, pattern in patterns:
        offset = 0
        for s in sorted(pattern, reverse=True):
            each = pattern[s]
            first = ranks.get(s, 0)
            ranks[s] = first + bins * each
            rows.append((s, first, ranks[s], base, each, offset))
            offset += each * s
        base += bins
    return rows


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    found = stage(pieces(docs, text, doc_id, capacity, vocabulary), "pieces")
    counts = stage(found.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")), "chunk-lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ahead = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("chunk", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    table = spark.createDataFrame(
        placements(solve(histogram, capacity)), "length long, first long, after long, base long, each long, at long"
    )
    ranked = found.join(offsets, ["chunk", "length"]).withColumn("place", F.col("rank") + F.col("ahead")).alias("p")
    t = F.broadcast(table).alias("t")
    here = (F.col("p.length") == F.col("t.length")) & (F.col("place") >= F.col("first")) & (F.col("place") < F.col("after"))
    index = F.col("place") - F.col("first")
    return ranked.join(t, here).select(
        "doc_id", "piece", "start", F.col("p.length").alias("length"), "ids_crc32",
        (F.col("base") + F.expr("(place - first) div each")).alias("sequence_id"),
        (F.col("at") + index % F.col("each") * F.col("p.length")).alias("offset"),
    )


def query(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
