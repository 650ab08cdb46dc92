"""Token counts kept as delta-maintained rollups by source, language and tokenizer version.

A batch is a set of signed rows: an insert adds a document and its tokens, a delete takes
both away, a revision adds the difference of its counts. A batch is aggregated before it
is stored, so the store grows with batches and groups, never with documents. Totals are
sums over committed batches, so their order doesn't matter.

A batch is committed by one rename of a finished folder to ``batch=<id>``. Committing an id
again changes nothing, whatever the rows; a run that dies before the rename leaves no trace
in the totals. One writer at a time may commit a given id.

Defined edge cases
* null text has no tokens and counts as a document; null source or language is a group
* an empty batch is committed and adds nothing; an empty store has no totals
* groups whose documents and tokens both sum to zero are left out of the totals
* other columns are ignored
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vocab
from .staging import new_folder, stage

KEYS = ("source", "lang", "version")
DELTA = "source string, lang string, version string, docs long, tokens long"
BATCHES = 4


def default_versions() -> dict[str, str]:
    """Tokenizer version -> vocabulary file (byte-level ranks)."""
    import public_tokenizers

    return {v: public_tokenizers.path(f"{v}.tiktoken") for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}


def _batches(batches: Iterator[pa.RecordBatch], versions: dict[str, str]) -> Iterator[pa.RecordBatch]:
    coders = {v: vocab.rank_bpe(path) for v, path in versions.items()}
    for batch in batches:
        texts = [t or "" for t in batch.column(3).to_pylist()]
        for version, coder in coders.items():
            counts = [len(coder.encode_to_numpy(t, disallowed_special=())) for t in texts]
            arrays = [*batch.columns[:3], pa.array([version] * len(texts), pa.string()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "source", "lang", "version", "tokens"])


def count_tokens(docs: DataFrame, versions: dict[str, str] | None = None, text: str = "text", doc_id: str = "doc_id",
                 source: str = "source", lang: str = "lang") -> DataFrame:
    """doc_id, source, lang, version, tokens: one row per document and version."""
    table = versions or default_versions()
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(lambda it: _batches(it, table), "doc_id long, source string, lang string, version string, tokens long")


def _signed(counts: DataFrame, docs: int, tokens: Column) -> DataFrame:
    return counts.select(*KEYS, F.lit(docs).cast("long").alias("docs"), tokens.cast("long").alias("tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return _signed(counts, 1, F.col("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return _signed(counts, -1, -F.col("tokens"))


def revisions(counts: DataFrame, old: str = "old_tokens", new: str = "tokens") -> DataFrame:
    """Same document, source and version, another count."""
    return _signed(counts, 0, F.col(new) - F.col(old))


class RollupStore:
    """Committed batches under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.folder))

    def _final(self, batch_id: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        return f"{self.folder}/batch={batch_id}"

    def committed(self) -> list[str]:
        found = self._fs.listStatus(self._path(self.folder))
        names = [f.getPath().getName() for f in found]
        return sorted(n.removeprefix("batch=") for n in names if n.startswith("batch="))

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch; False if its id is committed already."""
        final = self._final(batch_id)
        if self._fs.exists(self._path(final)):
            return False
        work = f"{self.folder}/_work-{uuid.uuid4().hex}"
        summed = deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        summed.write.parquet(work)
        if not self._fs.rename(self._path(work), self._path(final)):
            raise OSError(f"can't commit {batch_id}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, version, docs, tokens over all committed batches."""
        paths = [self._final(b) for b in self.committed()]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        summed = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs != 0 or tokens != 0")


def query(spark, sf_dir):
    """Totals of all documents, reached by a history of signed batches.

    Documents come in batches by id, the first one delivered twice and the last one with stale
    counts. All of them come once more without their language. Then the stale counts are
    revised, in a batch delivered twice, and the rows without language deleted. What is left
    equals a recount.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    counts = stage(count_tokens(docs), "token-counts")
    store = RollupStore(spark, new_folder(spark, "rollup"))
    part = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(BATCHES))
    stale = F.when(part == BATCHES - 1, F.col("tokens") * 2 + 1).otherwise(F.col("tokens"))
    first = counts.withColumn("old_tokens", stale)
    for k in [*range(BATCHES), 0]:
        store.commit(f"ingest-{k}", inserts(first.where(part == k).withColumn("tokens", F.col("old_tokens"))))
    unsorted = counts.withColumn("lang", F.lit(None).cast("string"))
    store.commit("ingest-unsorted", inserts(unsorted))
    store.commit("revise-stale", revisions(first.where(part == BATCHES - 1)))
    store.commit("retire-unsorted", deletes(unsorted))
    store.commit("revise-stale", revisions(first.where(part == BATCHES - 1)))
    return store.totals()
