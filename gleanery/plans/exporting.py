"""Queries for what leaves the engine and comes back: exported files, settings, fetch logs."""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Callable
from html import unescape
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..engine import Engine
from ..functions import text
from ..operators import choosing, discovery, fetching
from ..sources import pages as P
from ..sources import writers
from ..sources.config import Settings, read_settings, write_settings
from ..sources.shared import shared_folder
from .reading import CARDS, STATE, made
from .registry import query, table
from .tables import LISTINGS, stored_listings

_FIELDS = ["listing_id", "title", "price_value", "town", "attr_key_1"]
_SHOWN = "listing_id, title, coalesce(price_value::VARCHAR, '') AS price_value, coalesce(town, '') AS town, CASE WHEN k % 3 = 1 THEN 'v' || (k % 10) ELSE '' END AS attr_key_1"


def _shown(rows: DataFrame, read: Callable[[str], list]) -> DataFrame:
    """The fields of each text of ``rows``, as texts."""

    def run(batches):
        for batch in batches:
            found = [["" if v is None else str(v) for v in read(t)] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found, strict=True)] or [pa.array([], pa.string())] * len(_FIELDS), _FIELDS)

    return rows.mapInArrow(run, ", ".join(f"{c} string" for c in _FIELDS))


def _read_csv(spark, path: str) -> DataFrame:
    found = spark.read.csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST")
    return found.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in _FIELDS])


def _read_lines(spark, path: str) -> DataFrame:
    def read(line: str) -> list:
        row = json.loads(line)
        row["attr_key_1"] = row["attributes"].get("Key 1")
        return [row[c] for c in _FIELDS]

    return _shown(spark.read.text(path, lineSep="\n"), read)


_CELL = re.compile(r"<c(?: [^>]*)?/>|<c(?: [^>]*)?>.*?</c>", re.S)


def _cells(row: str) -> list[str]:
    return _CELL.findall(row.partition("<row>")[2])


def _cell_text(cell: str) -> str:
    return unescape(re.sub("<[^>]*>", "", cell))


def _read_sheet(spark, path: str) -> DataFrame:
    """The sheet is unpacked to a file by its rows, which executors read in ranges."""
    unpacked = shared_folder(spark, "sheet") + "/rows.xml"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    z = spark._jvm.java.util.zip.ZipInputStream(at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at))
    while z.getNextEntry().getName() != writers.SHEET:
        pass
    out = writers.open_to_write(spark, unpacked)
    writers.copy_bytes(spark, z, out)
    out.close()
    z.close()
    rows = spark.read.text(unpacked, lineSep="</row>").where(F.contains("value", F.lit("<row>")))
    first = F.startswith("value", F.lit("<worksheet"))
    names = [_cell_text(c) for c in _cells(rows.where(first).first()["value"])]
    places = [names.index(c) for c in _FIELDS]

    def read(row: str) -> list:
        cells = _cells(row)
        return [_cell_text(cells[i]) for i in places]

    return _shown(rows.where(~first), read)


_READERS = {"csv": _read_csv, "jsonl": _read_lines, "xlsx": _read_sheet}


def _back(spark, sf_dir, kind: str):
    """The listing table written to one file of its kind and read back, as texts."""
    path = f"{shared_folder(spark, 'listings')}/listings.{kind}"
    writers.export(stored_listings(spark, sf_dir), path)
    return _READERS[kind](spark, path)


@query(LISTINGS + f"SELECT {_SHOWN} FROM l")
def export_csv(spark, sf_dir):
    """SNK-03, SNK-12."""
    return _back(spark, sf_dir, "csv")


@query(LISTINGS + f"SELECT {_SHOWN} FROM l")
def export_jsonl(spark, sf_dir):
    """SNK-04, SNK-12."""
    return _back(spark, sf_dir, "jsonl")


@query(LISTINGS + f"SELECT {_SHOWN} FROM l")
def export_excel(spark, sf_dir):
    """SNK-05, SNK-12."""
    return _back(spark, sf_dir, "xlsx")


@query(LISTINGS + f"SELECT {_SHOWN} FROM l UNION ALL SELECT {_SHOWN} FROM l")
def export_pair(spark, sf_dir):
    """SNK-06: both files of the pair."""
    paths = writers.export_all(stored_listings(spark, sf_dir), shared_folder(spark, "listings"))
    return _READERS["csv"](spark, paths["csv"]).unionByName(_READERS["jsonl"](spark, paths["jsonl"]))


@query("SELECT * FROM (VALUES ('locale', '\"si\"'), ('max_listings', 'null'), ('max_pages_per_query', '7'), ('towns', '[\"Balangoda\"]')) t(name, value)")
def settings_file(spark, sf_dir):
    """SRC-16: what is written comes back, the rest is the default, unknown names are passed over."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "settings.json"
        write_settings(Settings(locale="si", max_pages_per_query=7, towns=["Balangoda"]), path)
        path.write_text(json.dumps(json.loads(path.read_text()) | {"later": 1}))
        found = read_settings(path)
    names = ["locale", "max_listings", "max_pages_per_query", "towns", "later"]
    return spark.createDataFrame([(n, json.dumps(found[n])) for n in names if n in found], "name string, value string")


@query("""
SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(replace(p_name, ' ', '-') || ' ''' || p_name, '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '') AS title FROM part
""")
def title_cased(spark, sf_dir):
    """STR-09: after hyphens and quotes too."""
    shown = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit(" '"), "p_name")
    return table(spark, sf_dir, "part").select("p_partkey", text.title_case(shown).alias("title"))


def _raises(page, *_):
    raise ValueError("a malformed node")


@query("SELECT 'state-blob' AS strategy, 2 * count(*) AS n FROM part")
def failing_strategy(spark, sf_dir):
    """UDF-03: a strategy that fails on every page costs itself its rows and nothing else."""
    broken = [P.Strategy("json-ld", _raises, _raises), *P.STRATEGIES[1:]]
    return choosing.strategy_counts(P.reads(made(spark, sf_dir, STATE), strategies=broken)).select("strategy", "n")


@query("SELECT '/en/ad/c-' || p_partkey || '?q=1' AS url, p_name AS title, 'Pelmadulla, Ratnapura' AS price_text FROM part")
def injected_selectors(spark, sf_dir):
    """UDF-04: learned selectors come before the built-in ones, here for the card and the price."""
    learned = {"card": "li[class*='ad-card']", "price": "[class*='description']"}
    found = P.reads(made(spark, sf_dir, CARDS), learned=learned).where("strategy = 'selectors' and price_text is not null")
    return found.select(F.regexp_replace("url", "^https://x.example", "").alias("url"), "title", "price_text")


_TRIES = """
WITH a AS (SELECT 'u' || user_id AS url, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 200 WHEN event_id % 7 = 0 THEN 404 ELSE 503 END AS status,
  CASE WHEN event_id % 2 = 0 THEN (event_id % 9)::VARCHAR ELSE 'soon' END AS retry_after FROM events),
s AS (SELECT *, min(attempt) FILTER (status IN (200, 404)) OVER (PARTITION BY url) AS settled FROM a WHERE attempt <= 4),
m AS (SELECT * FROM s WHERE settled IS NULL OR attempt <= settled)
"""


def _attempts(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("event_id")
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    status = F.when(k % 5 == 0, None).when(k % 3 == 0, 200).when(k % 7 == 0, 404).otherwise(503)
    after = F.when(k % 2 == 0, (k % 9).cast("string")).otherwise("soon")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"), at.alias("attempt"), status.alias("status"), after.alias("retry_after"))


@query(_TRIES + """SELECT url, (max(status) FILTER (status IN (200, 404)))::VARCHAR AS status, count(*) AS attempts,
  coalesce(sum(CASE WHEN status IS NULL THEN 2.0 ** attempt WHEN status = 503 THEN coalesce(try_cast(retry_after AS DOUBLE), 2.0 ** attempt) END), 0.0) AS paused,
  CASE WHEN count(*) FILTER (status IN (200, 404)) = 0 THEN CASE WHEN arg_max(coalesce(status, 0), attempt) = 0 THEN 'no connection' ELSE 'HTTP 503' END END AS error
FROM m GROUP BY url""")
def fetch_outcomes(spark, sf_dir):
    """SRC-05: retryable statuses, pauses, giving up."""
    return fetching.outcomes(_attempts(spark, sf_dir)).withColumn("status", F.col("status").cast("string"))


@query(_TRIES + """, c AS (SELECT DISTINCT url FROM m WHERE status = 200), w AS (SELECT DISTINCT 'u' || c_custkey AS url, c_custkey % 2 = 0 AS may FROM customer)
SELECT w.url, CASE WHEN c.url IS NOT NULL THEN 'cache' WHEN may THEN 'site' ELSE 'robots' END AS source FROM w LEFT JOIN c USING (url)""")
def answered_pages(spark, sf_dir):
    """SRC-01, SRC-02: a cached success is served whatever the robots rules, then these decide."""
    named = table(spark, sf_dir, "customer").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"), "c_custkey")
    cached = fetching.cacheable(fetching.outcomes(_attempts(spark, sf_dir)))
    return fetching.answered(named, cached, named.where("c_custkey % 2 = 0"))


@query("""
WITH r AS (SELECT user_id AS site, event_id AS ord, floor(epoch(ts))::BIGINT // 600 AS asked, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
s AS (SELECT *, max(asked - n * (3 + site % 2)) OVER (PARTITION BY site ORDER BY ord ROWS UNBOUNDED PRECEDING) + n * (3 + site % 2) AS started FROM r)
SELECT site, ord, started::BIGINT AS started, (started - asked)::BIGINT AS waited FROM s
""")
def request_pacing(spark, sf_dir):
    """SRC-04: the larger of the run's delay and the site's own between two requests."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("site"), F.col("event_id").alias("ord"), F.expr("unix_timestamp(cast(ts AS timestamp)) div 600").alias("asked"))
    return fetching.paced(rows, F.greatest(F.lit(3), 3 + F.col("site") % 2)).select("site", "ord", "started", "waited")


@query(LISTINGS + "SELECT 'listings' AS what, count(*) AS n FROM l UNION ALL SELECT 'new', count(*) FROM l UNION ALL SELECT 'updated', (SELECT count(*) FROM l WHERE k % 2 = 0)")
def engine_round_trip(spark, sf_dir):
    """UDF-07: a table kept by the engine, upserted twice."""
    engine = Engine(shared_folder(spark, "engine"), spark=spark)
    rows = stored_listings(spark, sf_dir).withColumn("seq", F.lit(1).cast("long"))
    first, _ = engine.upsert(rows)
    _, again = engine.upsert(rows.where(F.col("listing_id").cast("long") % 2 == 0))
    told = [("listings", engine.listings.count()), ("new", first), ("updated", again)]
    return spark.createDataFrame(told, "what string, n long")


@query("""
SELECT 'strategies' AS part, 'selectors' AS name, 2 * count(*) AS n FROM part UNION ALL SELECT 'strategies', 'link-heuristic', 2 * count(*) FROM part
UNION ALL SELECT 'card_candidates', 'li[class*=''ad-card'']', 2 * count(*) FROM part UNION ALL SELECT 'categories', 'all', 1
""")
def discovery_report(spark, sf_dir):
    """SNK-11: the saved report, read back."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "report.json"
        path.write_text(json.dumps(discovery.report(made(spark, sf_dir, CARDS))))
        found = json.loads(path.read_text())
    rows = [("strategies", k, n) for k, n in found["strategies"].items()] + [("card_candidates", c["selector"], c["matches"]) for c in found["card_candidates"]]
    return spark.createDataFrame(rows + [("categories", c, 1) for c in found["categories"]], "part string, name string, n long")
