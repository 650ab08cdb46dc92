"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Labels come from at most ``TRAIN_ROWS`` labelled rows, the first by a hash of their id:
a bounded, documented sample. Only these rows' texts are turned into features for
training; every text is scored in one pass over the table, batch by batch.

Label, language, source and id are no inputs of a score.

Defined edge cases
* null text counts as empty; empty texts are scored like any other
* null labels and labels of unknown documents are left out; of repeated labels all count
* no labels: every score is close to 1, as nothing speaks against any text
* empty table: empty result; other columns are passed through by ``score``; one that has the
  score's name keeps it, and the score gets the first free one of score_1, score_2, ...
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, fit

TRAIN_ROWS = 20_000
THRESHOLD = 0.7
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARKS = [ord(c) for c in "#*$%&|<>!?.,"]
_OTHER = np.zeros(256, bool)
_OTHER[33:128] = True
_OTHER &= ~(_UPPER | _LOWER | _DIGIT)
_OTHER[_MARKS] = False
FEATURES = 30


def features(text: str | None) -> list[float]:
    """Statistics of a whole text: character classes, words, lines, repetition."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if size else np.zeros(256, np.int64)
    per = 1.0 / max(size, 1)
    share = counts[counts > 0] * per
    words = raw.split()
    n = len(words)
    each = 1.0 / max(n, 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    tally = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    m = max(len(lines), 1)
    return [
        np.log1p(size), counts[_UPPER].sum() * per, counts[_LOWER].sum() * per, counts[_DIGIT].sum() * per,
        counts[_SPACE].sum() * per, counts[128:].sum() * per, counts[_OTHER].sum() * per,
        *(counts[c] * each for c in _MARKS),
        float(-(share * np.log2(share)).sum()), np.log1p(n), float(lengths.mean()) if n else 0.0,
        float(lengths.std()) if n else 0.0, float(lengths.max()) if n else 0.0, float((lengths <= 3).sum()) * each,
        len(tally) * each, max(tally.values(), default=0) * each, pairs / max(n - 1, 1),
        np.log1p(len(lines)), len(set(lines)) / m,
    ]


def matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(len(texts), FEATURES)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
          rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents. The caller leaves held-out labels out."""
    picked = (
        labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label"))
        .where("__id is not null and __label in (0, 1)")
        .orderBy(F.xxhash64("__id"), "__id", "__label").limit(rows)
    )
    # At most ``rows`` rows of two numbers: a bounded broadcast.
    joined = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__text")).join(F.broadcast(picked), "__id")

    def to_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"h": b["__h"], "y": b["__label"], "x": list(matrix(b["__text"].tolist()))})

    seen = joined.select("__text", "__label", F.xxhash64("__id").alias("__h")).mapInPandas(to_features, "h long, y int, x array<double>")
    # Documents may repeat an id; the bound holds for them too.
    seen = seen.orderBy("h", "y", "x").limit(rows).toPandas()
    x = np.array(seen["x"].tolist(), float).reshape(-1, FEATURES)
    order = np.lexsort([*x.T, seen["y"].to_numpy()])  # the same model, however tasks end
    return fit(x[order], seen["y"].to_numpy(float)[order])


def scorer(model: Trees):
    """A vectorised UDF text -> score."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(matrix(texts.tolist())))

    return score


def score(docs: DataFrame, model: Trees, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` and its scores, under a name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    free = (into if i == 0 else f"{into}_{i}" for i in range(len(taken) + 1))
    name = next(n for n in free if n.lower() not in taken)
    return docs.select("*", scorer(model)(F.col(text).cast("string")).alias(name))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 4) != 2)
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
