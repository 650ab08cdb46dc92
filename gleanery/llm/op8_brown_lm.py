"""LM scoring with a class-based bigram model; classes by exchange clustering.

P(text) = product over tokens of P(class | previous class) * P(token | class).

Training counts cover all training documents, and every training word gets a class:
* every token's count, in a table of any size on the shared folder;
* the most frequent words (``sizes``: their number and that of the classes grow with the
  vocabulary) are exchanged on the driver over their sparse bigram counts, until a round
  raises the bigram likelihood by less than ``ROUND_GAIN``;
* the other words among the ``KNOWN`` most frequent go where the classes of their neighbours
  are likeliest, by neighbour-class counts combined per task;
* all rarer words follow in the same way, one row an occurrence, by neighbours that have
  their classes by then. Words that are in no training document count as one more type of
  the class that most words met once have; the end has a class of its own.
Class transitions are then counted over all training tokens.

Every text is encoded once. Counts and classes of the ``KNOWN`` words (a fixed number) travel
with the code; the other words of a text meet their table in a join, one row a text and word.
No rare word is in more than 1/``KNOWN`` of the training tokens, so that join has no hot key.

Defined edge cases
* null text counts as empty: its only token is the end
* no training documents: N = V = 0 and every token has the floor's probability
* ties in frequency are broken by the word; repeated rows are scored and counted each
* null ids hash as the empty text; empty table: empty result; other columns are ignored
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage, unstage

#: The least class words and classes; ``sizes`` has more of both for more than ``KNOWN`` words.
CLASS_WORDS = 1000
CLASSES = 40
KNOWN = 50_000
#: The exchange has converged when a whole round of moves gains less than so many nats a token.
#: Single moves that gain less than the second number don't count, so that rounding can't keep them going.
ROUND_GAIN = 1e-4
LEAST_GAIN = 1e-9
END = ""
_FLUSH = 200_000
_PAIRS = 1_000_000
_PART = np.dtype([("side", "<u2"), ("n", "<u4")])


def sizes(distinct: int) -> tuple[int, int]:
    """Class words and classes, by the fourth root of the vocabulary."""
    grown = max(1.0, distinct / KNOWN) ** 0.25
    return round(CLASS_WORDS * grown), round(CLASSES * grown)


def remainder(doc_id: Column, modulus: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _strings(words) -> pa.Array:
    return pa.array(list(words), pa.binary()).cast(pa.string())


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, n) partial counts; the table is flushed before it grows beyond its bound."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([_strings(counts), pa.array(counts.values(), pa.int64())], ["w", "n"])
        counts.clear()
        return batch

    for batch in batches:
        for text in batch.column(0):
            counts.update(words_of(text.as_py()))
            counts[END.encode()] += 1
            if len(counts) > _FLUSH:
                yield out()
    if counts:
        yield out()


@dataclass(frozen=True)
class Lexicon:
    """The most frequent tokens, bounded by ``KNOWN``; the end token is kept apart."""

    index: dict[bytes, int]
    logs: np.ndarray  # log10(c + 0.5) by index
    class_words: int
    total: int
    distinct: int
    end_count: int
    counts: np.ndarray

    @property
    def floor(self) -> float:
        return math.log10(self.total + 0.5 * (self.distinct + 1))


#: Symbols beyond the class words: known, rare, end.
def _symbols(m: int) -> tuple[int, int, int]:
    return m, m + 1, m + 2


def _encode_batches(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """Per text: row, doc_id, held_out, n_tokens, logs and number of known tokens, the index of
    each token's word (that past the last for rare ones), rare words, and which of them comes
    at each rare token. ``row`` is unique in the table."""
    get, rare = lexicon.index.get, len(lexicon.counts)
    row = TaskContext.get().partitionId() << 40
    end_log = math.log10(lexicon.end_count + 0.5)
    for batch in batches:
        rows, sums, hits, lengths, codes, rares, places = [], [], [], [], [], [], []
        for text in batch.column(2):
            words = words_of(text.as_py())
            at = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            found = at >= 0
            sums.append(float(lexicon.logs[at[found]].sum()) + end_log)
            hits.append(int(found.sum()) + (lexicon.end_count > 0))
            lengths.append(len(words) + 1)
            codes.append(np.where(found, at, rare).astype("<u2").tobytes())
            other: dict[bytes, int] = {}
            places.append(np.array([other.setdefault(words[i], len(other)) for i in np.flatnonzero(~found)], "<i4").tobytes())
            rares.append([w.decode("utf-8", "surrogatepass") for w in other])
            rows.append(row)
            row += 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int64()), batch.column(0), batch.column(1), pa.array(lengths, pa.int64()), pa.array(sums, pa.float64()),
                pa.array(hits, pa.int64()), pa.array(codes, pa.binary()), pa.array(rares, pa.list_(pa.string())), pa.array(places, pa.binary()),
            ],
            ["row", "doc_id", "held_out", "n_tokens", "log_sum", "hits", "code", "rare", "places"],
        )


_ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, log_sum double, hits long, code binary, rare array<string>, places binary"


def _counted(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct numbers and their counts, combined as far as ``_PAIRS`` of them allow."""
    keys, counts, waiting, n = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def combined() -> tuple[np.ndarray, np.ndarray]:
        new, times = np.unique(np.concatenate([np.zeros(0, np.int64), *waiting]), return_counts=True)
        waiting.clear()
        both, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
        return both, np.bincount(inverse, np.concatenate([counts, times]), len(both)).astype(np.int64)

    for part in parts:
        waiting.append(part)
        n += len(part)
        if n > _PAIRS:
            keys, counts = combined()
            n = 0
            if len(keys) > _PAIRS:
                yield keys, counts
                keys = counts = np.zeros(0, np.int64)
    keys, counts = combined()
    if len(keys):
        yield keys, counts


def _bigram_batches(batches: Iterator[pa.RecordBatch], of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(a, b, n): bigrams of what ``of`` makes of a code; its last entry is the end's."""
    size, end = int(of.max()) + 1, of[-1]

    def bigrams(code) -> np.ndarray:
        ids = np.concatenate([[end], of[np.frombuffer(code.as_py(), "<u2")], [end]])
        return ids[:-1] * size + ids[1:]

    for keys, counts in _counted(bigrams(code) for batch in batches for code in batch.column(0)):
        for at in np.array_split(np.arange(len(keys)), max(1, len(keys) // 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(keys[at] // size, pa.int32()), pa.array(keys[at] % size, pa.int32()), pa.array(counts[at])], ["a", "b", "n"])


def bigrams_of(codes: DataFrame, of: np.ndarray) -> np.ndarray:
    """Rows (a, b, n) of all bigrams of the one column of codes."""
    pairs = codes.mapInArrow(partial(_bigram_batches, of=of), "a int, b int, n long")
    rows = pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    return np.column_stack([rows.column(c).to_numpy().astype(np.int64) for c in ("a", "b", "n")])


def _table(rows: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[rows[:, 0], rows[:, 1]] = rows[:, 2]
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def _split(keys: np.ndarray, others: np.ndarray, n: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per key the others and their counts."""
    order = np.argsort(keys, kind="stable")
    ends = np.searchsorted(keys[order], np.arange(1, size))
    return list(zip(np.split(others[order], ends), np.split(n[order], ends), strict=True))


def exchange(bigrams: np.ndarray, movable: int, classes: int, rounds: int | None = None) -> np.ndarray:
    """Class of every symbol. The first ``movable`` symbols are exchanged among ``classes``
    classes while the class bigram likelihood grows; the others keep classes of their own."""
    a, b = np.nonzero(bigrams)
    return exchange_rows(np.column_stack([a, b, bigrams[a, b]]), len(bigrams), movable, classes, rounds)


def exchange_rows(rows: np.ndarray, size: int, movable: int, classes: int, rounds: int | None = None) -> np.ndarray:
    """``exchange`` of bigrams given as rows (a, b, n); without ``rounds``, until it has converged."""
    of = np.concatenate([np.arange(movable) % classes, classes + np.arange(size - movable)])
    k = classes + size - movable
    table = np.zeros((k, k))
    np.add.at(table, (of[rows[:, 0]], of[rows[:, 1]]), rows[:, 2])
    selves = np.zeros(size)
    same = rows[:, 0] == rows[:, 1]
    selves[rows[same, 0]] = rows[same, 2]
    apart = rows[~same]
    afters, befores = _split(apart[:, 0], apart[:, 1], apart[:, 2], size), _split(apart[:, 1], apart[:, 0], apart[:, 2], size)
    base, place = _xlogx(table), np.arange(classes)
    total = max(1.0, float(table.sum()))
    least = LEAST_GAIN * total

    def change(c: int, r: np.ndarray, col: np.ndarray, self_n: float) -> None:
        table[c] += r
        table[:, c] += col
        table[c, c] += self_n
        base[c], base[:, c] = _xlogx(table[c]), _xlogx(table[:, c])

    done = 0
    while rounds is None or done < rounds:
        gained = 0.0
        for w in range(movable):
            self_n = selves[w]
            r, c = (np.bincount(of[at], n, k) for at, n in (afters[w], befores[w]))
            old = of[w]
            change(old, -r, -c, -self_n)
            diagonal, base_diagonal = table[place, place], base[place, place]
            j, i = np.flatnonzero(r), np.flatnonzero(c)
            with_r = _xlogx(table[:classes, j] + r[j]) - base[:classes, j]
            with_c = _xlogx(table[i, :classes] + c[i, None]) - base[i, :classes]
            gain = with_r.sum(1) + with_c.sum(0) + _xlogx(diagonal + (r + c)[:classes] + self_n) - base_diagonal
            gain -= _xlogx(diagonal + r[:classes]) + _xlogx(diagonal + c[:classes]) - 2 * base_diagonal
            # The word is its neighbours' neighbour wherever it goes.
            n_rows, n_cols = table[:classes].sum(1) + c[:classes], table[:, :classes].sum(0) + r[:classes]
            gain -= _xlogx(n_rows + r.sum() + self_n) - _xlogx(n_rows) + _xlogx(n_cols + c.sum() + self_n) - _xlogx(n_cols)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + least:
                new = old
            gained += float(gain[new] - gain[old])
            of[w] = new
            change(new, r, c, self_n)
        done += 1
        if gained < ROUND_GAIN * total:
            break
    return of


@dataclass(frozen=True)
class ClassModel:
    of: np.ndarray  # class of each symbol
    transition: np.ndarray  # log10 P(class | previous class)
    norm: np.ndarray  # log10 of each class's emission denominator


def estimate(table: np.ndarray, tokens: np.ndarray, types: np.ndarray, of: np.ndarray, prior: float = 20.0) -> ClassModel:
    """Transitions interpolated with the class unigram; emissions add-half within the class."""
    unigram = (table.sum(0) + 0.5) / (table.sum() + 0.5 * len(table))
    transition = (table + prior * unigram) / (table.sum(1, keepdims=True) + prior)
    return ClassModel(of, np.log10(transition), np.log10(np.maximum(tokens + 0.5 * types, 0.5)))


def _rare(lexicon: Lexicon) -> tuple[int, int]:
    """Tokens and types beyond the listed ones; unseen words are one more type."""
    listed = lexicon.counts.sum() + lexicon.end_count
    return max(lexicon.total - listed, 0), max(lexicon.distinct - len(lexicon.counts) - (lexicon.end_count > 0), 0) + 1


def class_model(bigrams: np.ndarray, lexicon: Lexicon, classes: int, rounds: int | None = None, prior: float = 20.0) -> ClassModel:
    """The model of the class words, by which the other words get their classes."""
    a, b = np.nonzero(bigrams)
    return core_model(np.column_stack([a, b, bigrams[a, b]]), lexicon, classes, rounds, prior)


def core_model(rows: np.ndarray, lexicon: Lexicon, classes: int, rounds: int | None = None, prior: float = 20.0) -> ClassModel:
    """``class_model`` of bigrams given as rows (a, b, n)."""
    m = lexicon.class_words
    known, rare, end = _symbols(m)
    of = exchange_rows(rows, m + 3, m, classes, rounds)
    k = int(of.max()) + 1
    table = np.zeros((k, k))
    np.add.at(table, (of[rows[:, 0]], of[rows[:, 1]]), rows[:, 2])
    tokens, types = np.zeros(k), np.zeros(k)
    np.add.at(tokens, of[:m], lexicon.counts[:m])
    np.add.at(types, of[:m], 1)
    tokens[of[known]], types[of[known]] = lexicon.counts[m:].sum(), len(lexicon.counts) - m
    tokens[of[end]], types[of[end]] = lexicon.end_count, 1
    tokens[of[rare]], types[of[rare]] = _rare(lexicon)
    return estimate(table, tokens, types, of, prior)


def sides(model: ClassModel, classes: int) -> np.ndarray:
    """What one neighbour says for each of the first ``classes`` classes: rows are the classes
    of the token before, then those of the token after. Each has half of the emission."""
    before, after = model.transition[:, :classes], model.transition[:classes].T
    return np.concatenate([before, after]) - model.norm[:classes] / 2


def _side_batches(batches: Iterator[pa.RecordBatch], of: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """(id, part): a task's neighbour-class counts of the known words from ``first`` on."""
    k, end, rare = int(of.max()) + 1, of[-1], len(of) - 2

    def neighbours(code) -> np.ndarray:
        ids = np.frombuffer(code.as_py(), "<u2").astype(np.int64)
        classes = np.concatenate([[end], of[ids], [end]])
        at = np.flatnonzero((ids >= first) & (ids < rare))
        return np.concatenate([ids[at] * 2 * k + classes[at], ids[at] * 2 * k + k + classes[at + 2]])

    for keys, counts in _counted(neighbours(code) for batch in batches for code in batch.column(0)):
        packed = np.zeros(len(keys), _PART)
        packed["side"], packed["n"] = keys % (2 * k), counts
        ids, starts = np.unique(keys // (2 * k), return_index=True)
        parts = [p.tobytes() for p in np.split(packed, starts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(parts, pa.binary())], ["id", "part"])


def _assign_known(batches: Iterator[pa.RecordBatch], said: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best = []
        for parts in batch.column(1):
            part = np.frombuffer(b"".join(parts.as_py()), _PART)
            counts = np.bincount(part["side"], part["n"], len(said))
            best.append(int((counts @ said).argmax()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int32())], ["id", "class"])


def _rare_batches(batches: Iterator[pa.RecordBatch], of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(w, near): rare words, an occurrence each, and the classes before and after."""
    k, end, rare = int(of.max()) + 1, of[-1], len(of) - 2
    for batch in batches:
        for code, words, places in zip(*batch.columns, strict=True):
            ids = np.frombuffer(code.as_py(), "<u2")
            at = np.flatnonzero(ids == rare)
            if len(at):
                classes = np.concatenate([[end], of[ids], [end]])
                w = words.values.take(pa.array(np.frombuffer(places.as_py(), "<i4")))
                yield pa.RecordBatch.from_arrays([w, pa.array(classes[at] * k + classes[at + 2], pa.int32())], ["w", "near"])


def _assign_rare(batches: Iterator[pa.RecordBatch], said: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = len(said) // 2
    for batch in batches:
        near = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        lengths = np.array(batch.column(1).value_lengths())
        word = np.repeat(np.arange(len(lengths)), lengths)
        sums = np.zeros((len(lengths), said.shape[1]))
        for i in range(0, len(near), 20_000):
            part, owner = near[i : i + 20_000], word[i : i + 20_000]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sums[owner[starts]] += np.add.reduceat(said[part // k] + said[k + part % k], starts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(sums.argmax(1), pa.int32())], ["w", "c", "class"])


def _fill_batches(batches: Iterator[pa.RecordBatch], of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Texts as classes, with the counts of their rare words added."""
    rare = len(of) - 2
    for batch in batches:
        codes, known, logs = [], [], []
        for code, places, found in zip(batch.column("code"), batch.column("places"), batch.column("found"), strict=True):
            ids, at = np.frombuffer(code.as_py(), "<u2"), np.frombuffer(places.as_py(), "<i4")
            classes = of[ids]
            kinds, counts = np.full(int(at.max(initial=-1)) + 1, of[rare]), np.zeros(int(at.max(initial=-1)) + 1, np.int64)
            if found.is_valid:
                j, c, of_w = (x.to_numpy(zero_copy_only=False) for x in found.values.flatten())
                kinds[j], counts[j] = of_w, c
            classes[ids == rare] = kinds[at]
            codes.append(classes.astype("<u2").tobytes())
            known.append(int((counts[at] > 0).sum()))
            logs.append(float(np.log10(counts[at] + 0.5).sum()))
        n_known = pa.compute.add(batch.column("hits"), pa.array(known, pa.int64()))
        sums = pa.compute.add(batch.column("log_sum"), pa.array(logs, pa.float64()))
        kept = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*kept, n_known, sums, pa.array(codes, pa.binary())], ["doc_id", "held_out", "n_tokens", "n_known", "logs", "code"])


_FILLED = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, code binary"


def _class_batches(batches: Iterator[pa.RecordBatch], model: ClassModel) -> Iterator[pa.RecordBatch]:
    """Adds class_part: the log10 probability of a text's classes, less the emission denominators."""
    end = len(model.norm) - 1
    for batch in batches:
        parts = []
        for code in batch.column(5):
            ids = np.concatenate([[end], np.frombuffer(code.as_py(), "<u2"), [end]]).astype(np.int64)
            parts.append(float(model.transition[ids[:-1], ids[1:]].sum() - model.norm[ids[1:]].sum()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(parts, pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "logs", "class_part"])


def lexicon_of(table: DataFrame, class_words: int | None = None, known: int = KNOWN) -> Lexicon:
    sums = table.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    end = table.where(F.col("w") == END).first()
    top = table.where(F.col("w") != END).orderBy(F.desc("c"), "w").limit(known).collect()
    counts = np.array([r["c"] for r in top], np.int64)
    index = {r["w"].encode("utf-8", "surrogatepass"): i for i, r in enumerate(top)}
    class_words = class_words or sizes(int(sums["v"]))[0]
    return Lexicon(index, np.log10(counts + 0.5), min(class_words, len(top)), int(sums["n"]), int(sums["v"]), int(end["c"]) if end else 0, counts)


def word_classes(encoded: DataFrame, lexicon: Lexicon, classes: int) -> tuple[np.ndarray, DataFrame]:
    """Classes of the known words, then of unseen ones and the end; and a staged table
    (w, c, class) of all rare training words."""
    train = encoded.where("not held_out")
    m, n = lexicon.class_words, len(lexicon.counts)
    symbols = np.concatenate([np.minimum(np.arange(n), m), [m + 1, m + 2]])
    core = core_model(bigrams_of(train.select("code"), symbols), lexicon, classes)
    of = core.of[symbols]
    if n > m:
        parts = train.select("code").mapInArrow(partial(_side_batches, of=of, first=m), "id int, part binary")
        parts = parts.groupBy("id").agg(F.collect_list("part").alias("parts"))
        rows = parts.mapInArrow(partial(_assign_known, said=sides(core, classes)), "id int, class int").toPandas()
        of[rows["id"].to_numpy()] = rows["class"].to_numpy()
    of[n], of[n + 1] = classes, classes + 1
    table = _table(bigrams_of(train.select("code"), of), classes + 2)
    tokens, types = np.bincount(of[:n], lexicon.counts, classes + 2), np.bincount(of[:n], minlength=classes + 2).astype(float)
    tokens[classes], types[classes] = _rare(lexicon)
    tokens[classes + 1], types[classes + 1] = lexicon.end_count, 1
    said = sides(estimate(table, tokens, types, of), classes)
    near = train.select("code", "rare", "places").mapInArrow(partial(_rare_batches, of=of), "w string, near int")
    near = near.groupBy("w").agg(F.collect_list("near").alias("near"))
    rare = stage(near.mapInArrow(partial(_assign_rare, said=said), "w string, c long, class int"), "rare-classes")
    once = np.bincount(of[:n][lexicon.counts == 1], minlength=classes)
    for r in rare.where("c = 1").groupBy("class").count().collect():
        once[r["class"]] += r["count"]
    of[n], of[n + 1] = int(once.argmax()), classes
    return of, rare


def final_model(filled: DataFrame, rare: DataFrame, of: np.ndarray, lexicon: Lexicon, classes: int) -> ClassModel:
    """Transitions over all training tokens; unseen words are one more type of their class."""
    n = len(lexicon.counts)
    table = _table(bigrams_of(filled.where("not held_out").select("code"), np.arange(classes + 1)), classes + 1)
    tokens, types = np.bincount(of[:n], lexicon.counts, classes + 1), np.bincount(of[: n + 1], minlength=classes + 1).astype(float)
    for r in rare.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        tokens[r["class"]] += r["c"]
        types[r["class"]] += r["n"]
    tokens[classes], types[classes] = lexicon.end_count, 1
    return estimate(table, tokens, types, of)


def score(docs: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id", class_words: int | None = None,
          classes: int | None = None, known: int = KNOWN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))
    counted = slim.where("not held_out").select("text").mapInArrow(_count_batches, "w string, n long")
    table = stage(counted.groupBy("w").agg(F.sum("n").alias("c")), "word-counts")
    lexicon = lexicon_of(table, class_words, known)
    classes = classes or sizes(lexicon.distinct)[1]
    unstage(table)
    encoded = stage(slim.mapInArrow(partial(_encode_batches, lexicon=lexicon), _ENCODED), "encoded")
    of, rare = word_classes(encoded, lexicon, classes)
    words = encoded.select("row", F.posexplode("rare").alias("j", "w"))
    # A step of its own, whose shuffles have ended before the texts are moved.
    found = stage(words.join(rare, "w").groupBy("row").agg(F.collect_list(F.struct("j", "c", "class")).alias("found")), "found")
    joined = encoded.select("row", "doc_id", "held_out", "n_tokens", "log_sum", "hits", "code", "places").join(found, "row", "left")
    filled = stage(joined.mapInArrow(partial(_fill_batches, of=of), _FILLED), "filled")
    model = final_model(filled, rare, of, lexicon, classes)
    for done in (encoded, rare, found):
        unstage(done)
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, class_part double"
    out = filled.mapInArrow(partial(_class_batches, model=model), kinds).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(lexicon.floor)).alias("base_score"), (F.col("logs") + F.col("class_part")).alias("score"),
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), F.least(-F.col("score") / F.col("n_tokens"), F.lit(300.0))))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, remainder(F.col("doc_id"), 5) == 1)
