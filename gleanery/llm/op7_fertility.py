"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback cuts every whole text. Three measures come of it:
characters a token, the share of byte-fallback tokens, and the entropy of the tokens as a
share of what as many tokens could have at most. Per language and size class, quartiles
over all documents give rejection bands: a text whose measure lies further outside the
quartiles than ``FENCES`` allow is rejected. Groups of fewer than ``LEAST`` documents take
the quartiles of their language's distances from the size trend, languages of fewer than
that those of all documents. The trend is the median of each size class over all documents;
distances are in interquartile ranges of the size class, as short texts vary more.

Base rules come first: too few words, or too many words in repeated 5-word windows.

Defined edge cases
* null text: no words, base_failed
* null language: a language of its own
* a size class of fewer than ``LEAST`` documents has its trend from the line through the two
  nearest others, or the one there is
* ties and repeated rows are judged alike; empty table: empty result
* other columns are ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .lookup import attach
from .staging import stage

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Interquartile ranges below and above the quartiles that still pass: Tukey's far-out
#: fence, three times wider where a text suits the vocabulary better than its peers.
FENCES = {"chars_per_token": (3.0, 9.0), "byte_share": (3.0, 3.0), "entropy_share": (3.0, 3.0)}
MEASURES = tuple(FENCES)
#: Bands are never narrower than this share of the median on either side.
SLACK = 0.05
LEAST = 30
SYMBOLS = b"#*$%&|<>"
_SPACES = " \t\n\v\f\r"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur at least twice. Exact: windows are ranked, not hashed."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    code = ids[:n]
    for k in range(1, window):
        code = np.unique(code * len(known) + ids[k : k + n], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : k + n] |= twice
    return int(covered.sum())


def base_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    doubles = 0
    for line in raw.split(b"\n"):
        if line in seen:
            doubles += bool(line.split(None, 1))
        else:
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, _SPACES)), sum(raw.count(c) for c in SYMBOLS),
        doubles, repeated_words(words),
    )


def token_measures(text: str | None, pieces, is_byte: np.ndarray) -> tuple[int, float, float, float]:
    """n_tokens and the three measures; zeros for texts without tokens."""
    ids = np.array(pieces.encode(text or ""), np.int64)
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    share = np.unique(ids, return_counts=True)[1] / n
    entropy = float(-(share * np.log2(share)).sum())
    return n, len(text or "") / n, float(is_byte[ids].mean()), entropy / np.log2(n) if n > 1 else 1.0


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string())]
    + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")]
    + [(c, pa.float64()) for c in MEASURES]
)
_DDL = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, " + ", ".join(f"{c} double" for c in MEASURES)


def _batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = vocab.piece_bpe(path)
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    for batch in batches:
        rows = []
        for text in batch.column(2):
            text = text.as_py()
            rows.append((*base_measures(text), *token_measures(text, pieces, is_byte)))
        columns = zip(*rows, strict=True) if rows else [()] * (len(_SCHEMA) - 2)
        arrays = [batch.column(0), batch.column(1), *(pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[2:], strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def measure(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", vocabulary: str | None = None) -> DataFrame:
    path = vocabulary or vocab.piece_bpe_path()
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("?")).alias("lang"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _batches(it, path), _DDL)


def with_size_class(measured: DataFrame) -> DataFrame:
    """Adds the size class: tokens by powers of four."""
    return measured.withColumn("size_class", F.floor(F.log2(F.col("n_tokens") + 1) / 2).cast("int"))


def _along(solid: dict[int, float], s: int) -> float:
    """The value at ``s``, or that of the line through the two nearest."""
    near = sorted(solid, key=lambda x: (abs(x - s), x))[:2]
    if s in solid or len(near) < 2:
        return solid[near[0]] if near else 0.0
    a, b = near
    return solid[a] + (solid[b] - solid[a]) * (s - a) / (b - a)


def trends(sound: DataFrame) -> dict[str, dict[int, tuple[float, float]]]:
    """Per measure the median and the spread of each size class; size classes are logarithms, so few."""
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(c) for c in MEASURES]
    rows = sound.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"), *quartiles).collect()
    out = {}
    for c in MEASURES:
        mid = {r["size_class"]: r[c][1] for r in rows if r["n"] >= LEAST}
        spread = {r["size_class"]: max(r[c][2] - r[c][0], 1e-3) for r in rows if r["n"] >= LEAST}
        out[c] = {s: (_along(mid, s), max(_along(spread, s), min(spread.values(), default=1.0))) for s in (r["size_class"] for r in rows)}
    return out


def bands(measured: DataFrame, fences: dict[str, tuple[float, float]] = FENCES) -> DataFrame:
    """lang, size_class and per measure the least and most that pass."""
    sound = measured.where(F.col("n_tokens") > 0)
    known = trends(sound)

    def at(c: str, i: int) -> Column:
        pairs = [F.lit(x) for s, v in (known[c] or {0: (0.0, 1.0)}).items() for x in (s, v[i])]
        return F.element_at(F.create_map(*pairs), F.col("size_class"))

    trend, spread = ({c: at(c, i) for c in MEASURES} for i in (0, 1))

    def quartiles(name: str) -> list[Column]:
        return [F.percentile_approx(c, [0.25, 0.5, 0.75], 2000).alias(f"{c}{name}") for c in MEASURES]

    n = F.count(F.lit(1))
    own = sound.groupBy("lang", "size_class").agg(n.alias("n"), *quartiles(""))
    off = sound.withColumns({c: (F.col(c) - trend[c]) / spread[c] for c in MEASURES})
    by_lang = off.groupBy("lang").agg(n.alias("lang_n"), *quartiles("_lang")).where(F.col("lang_n") >= LEAST)
    out = own.join(by_lang, "lang", "left").crossJoin(F.broadcast(off.agg(*quartiles("_all"))))
    limits = []
    for c in MEASURES:
        low, mid, high = (
            F.when(F.col("n") >= LEAST, F.element_at(c, i)).otherwise(trend[c] + spread[c] * F.element_at(F.coalesce(f"{c}_lang", f"{c}_all"), i)) for i in (1, 2, 3)
        )
        below, above = (F.greatest(F.lit(k) * (high - low), F.lit(SLACK) * mid, F.lit(0.02)) for k in fences[c])
        limits += [(low - below).alias(f"{c}_least"), (high + above).alias(f"{c}_most")]
    return out.select("lang", "size_class", *limits)


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", vocabulary: str | None = None) -> DataFrame:
    """Per document its measures, base_failed and kept."""
    measured = stage(with_size_class(measure(docs, text, doc_id, lang, vocabulary)), "fertility")
    limits = stage(bands(measured), "bands")
    joined = attach(measured, limits, ["lang", "size_class"], F.col("doc_id"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    inside = F.lit(True)
    for c in MEASURES:
        inside &= F.coalesce(F.col(c).between(F.col(f"{c}_least"), F.col(f"{c}_most")), F.lit(True))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
        (~base_failed & inside).alias("kept"), "n_tokens", *MEASURES,
    )


def query(spark, sf_dir):
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
