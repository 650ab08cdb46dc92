"""URL filters: host and path rules, and boosted trees on lexical features beyond them.

Labelled URLs are those that a rule decides. The trees are trained on at most
``TRAIN_ROWS`` of them, the first by a hash of the URL (a bounded, documented sample).
Suffix statistics, the share of allowed URLs by host suffix and by path suffix, cover
all labelled URLs in ``SUFFIX_BUCKETS`` hashed buckets each. A URL that trains gets the
shares of the other ``FOLDS`` folds, dealt by host, so its own verdict is not among them.

Defined edge cases
* null urls and urls without ``://``: empty host and path; no rule fits, the model decides
* no labelled URL: everything without a rule is allowed
* URLs of any length are read whole; only features of the trained ones reach the driver
* of rules that fit, the one with the most characters (host and path) wins, then the first given
* empty table: empty result; other columns are ignored
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Trees, fit

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
TRAIN_ROWS = 20_000
SUFFIX_BUCKETS = 512
FOLDS = 5
FEATURES = 19


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    fits = []
    for _, rule in ordered:
        at = rule.index("/")
        own = rule[:at]
        fits.append(((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(rule[at:])))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for fit_, (what, text) in reversed(list(zip(fits, ordered, strict=True))):
        rule, verdict = F.when(fit_, text).otherwise(rule), F.when(fit_, what).otherwise(verdict)
    return rule, verdict


def judged(pages: DataFrame, url: str = "url", key: str = "page_id", rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, ruled (the rule's verdict)."""
    named = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    named = named.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return named.withColumns({"rule": rule, "ruled": verdict})


def _bucket(text: Column) -> Column:
    return (F.crc32(F.encode(text, "UTF-8")) % SUFFIX_BUCKETS).cast("int")


def host_suffix(host: Column) -> Column:
    """The last label of the host."""
    return F.substring_index(host, ".", -1)


def path_suffix(path: Column) -> Column:
    """The last segment's file suffix, else the first segment."""
    found = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    return F.when(found != "", F.concat(F.lit("."), found)).otherwise(F.substring_index(F.substr(path, F.lit(2)), "/", 1))


def suffix_statistics(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed shares of allowed URLs by host suffix and by path suffix: row f has those a bucket
    without fold f, the last row those of all."""
    allowed = F.when(F.col("ruled") == "allow", 1).otherwise(0)
    out = []
    for column in ("hs", "ps"):
        counts = labelled.groupBy(column, "fold").agg(F.sum(allowed).alias("a"), F.count(F.lit(1)).alias("n")).collect()
        a, n = np.zeros((FOLDS + 1, SUFFIX_BUCKETS)), np.zeros((FOLDS + 1, SUFFIX_BUCKETS))
        for r in counts:
            others = np.arange(FOLDS + 1) != r["fold"]
            a[others, r[column]] += r["a"]
            n[others, r[column]] += r["n"]
        out.append((a + 1) / (n + 2))
    return out[0], out[1]


def _entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def features(url: str | None, host: str, path: str) -> list[float]:
    """Lexical features of one URL."""
    whole = url or ""
    tail = re.split(r"[?#]", whole, maxsplit=1)
    query = whole.split("?", 1)[1].split("#", 1)[0] if "?" in whole else ""
    n, h, p = max(len(whole), 1), max(len(host), 1), max(len(path), 1)
    labels, segments = host.split("."), [s for s in path.split("/") if s]
    digits = sum(c.isdigit() for c in whole)
    return [
        len(whole), len(host), len(path), len(query), len(segments), len(labels), digits / n,
        sum(c.isdigit() for c in host) / h, sum(c.isdigit() for c in path) / p,
        _entropy(whole), _entropy(host), _entropy(path), float(len([x for x in query.split("&") if x])),
        host.count("-"), whole.count("%"), max(map(len, segments), default=0), len(tail) - 1,
    ]


def matrix(urls, hosts, paths, hs, ps, shares, folds=FOLDS) -> np.ndarray:
    """Features of a batch; ``folds`` says whose shares each row gets, by default those of all."""
    own = np.array([features(u, h, p) for u, h, p in zip(urls, hosts, paths, strict=True)], float).reshape(len(hosts), FEATURES - 2)
    return np.column_stack([own, shares[0][folds, np.asarray(hs, int)], shares[1][folds, np.asarray(ps, int)]])


def train(labelled: DataFrame, shares, limit: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``limit`` labelled URLs; label 1 is allow."""

    def to_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = matrix(b["url"], b["host"], b["path"], b["hs"], b["ps"], shares, b["fold"].to_numpy(int))
            yield pd.DataFrame({"y": (b["ruled"] == "allow").astype("int32"), "x": list(x)})

    picked = labelled.orderBy(F.xxhash64("url"), "url", "page_id").limit(limit)
    seen = picked.drop("page_id", "rule").mapInPandas(to_features, "y int, x array<double>").toPandas()
    x, y = np.array(seen["x"].tolist(), float).reshape(-1, FEATURES), seen["y"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # the same model, however rows arrive
    return fit(x[order], y[order], trees=40)


def filter_urls(pages: DataFrame, url: str = "url", key: str = "page_id", rules=RULES, limit: int = TRAIN_ROWS, learn: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of allow). ``learn``: a
    condition on url, host and path; only labelled URLs that meet it are learned from."""
    rows = judged(pages, url, key, rules)
    rows = rows.withColumns({"hs": _bucket(host_suffix(F.col("host"))), "ps": _bucket(path_suffix(F.col("path")))})
    labelled = rows.where(F.col("ruled").isNotNull() & (F.lit(True) if learn is None else learn))
    labelled = labelled.withColumn("fold", F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int"))
    shares = suffix_statistics(labelled)
    model = train(labelled, shares, limit)

    @F.pandas_udf("double")
    def score(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for urls, hosts, paths, hs, ps in it:
            yield pd.Series(model.score(matrix(urls, hosts, paths, hs, ps, shares)))

    scored = rows.withColumn("score", score("url", "host", "path", "hs", "ps"))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def query(spark, sf_dir):
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
