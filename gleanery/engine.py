"""The engine's programming interface: one object over a folder of tables."""

from __future__ import annotations

from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import crawl, merging, reporting
from .schemas import PAGES_LOG, STORED_LISTING
from .session import session
from .sources import tables, writers
from .sources.config import Settings
from .sources.snapshots import Snapshots


class Engine:
    """A listing table and a page log under one folder, on any file system that Spark knows.

    Each change writes the next snapshot beside the old one; one small file names the current
    snapshot, and the one before it is kept until the next change.
    """

    def __init__(self, folder: str, settings: Settings | None = None, spark: SparkSession | None = None):
        self.spark = spark or session()
        self.settings = settings or Settings()
        self._listings = Snapshots(self.spark, f"{folder.rstrip('/')}/listings")
        self._log = Snapshots(self.spark, f"{folder.rstrip('/')}/pages")

    @property
    def listings(self) -> DataFrame:
        now = self._listings.current()
        return self.spark.createDataFrame([], STORED_LISTING) if now is None else tables.migrate(now, STORED_LISTING)

    @property
    def page_log(self) -> DataFrame:
        now = self._log.current()
        return self.spark.createDataFrame([], PAGES_LOG) if now is None else now

    def upsert(self, incoming: DataFrame) -> tuple[int, int]:
        """Fold listings with ``seq`` (their order) into the table: (new, updated)."""
        stored = self.listings
        counts = merging.upsert_counts(stored, incoming).first()
        self._listings.replace(merging.upsert(stored, incoming))
        return counts["new"], counts["updated"]

    def _logged(self, rows: DataFrame, stamp: str) -> None:
        told = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast("string" if c not in ("status", "listings") else "int").alias(c) for c in PAGES_LOG.names])
        told = told.withColumn("visited_at", F.lit(stamp))
        self._log.replace(told.join(self.page_log.select("url"), "url", "left_anti").unionByName(self.page_log.join(told.select("url"), "url", "left_anti")).unionByName(told.join(self.page_log.select("url"), "url", "left_semi")))

    def crawl(self, site: DataFrame, details: bool | None = None, progress: crawl.Progress = lambda message: None) -> str:
        """One run over a table of pages (url, status, html): search tiers, then pending details.
        Returns the run's summary in a line."""
        stamp = datetime.now(UTC).isoformat(timespec="seconds")
        now = F.lit(stamp).cast("timestamp")
        listings, log, summary = crawl.crawl(site, self.listings, self.page_log, self.settings, now, F.lit(stamp), progress)
        self._listings.replace(listings)
        self._logged(log, stamp)
        text = summary.first()["summary"]
        if self.settings["fetch_detail_pages"] if details is None else details:
            limit = self.settings["max_listings"]
            if not limit or self.listings.count() < limit:
                enriched, visits = crawl.enrich(self.listings, site, self.settings, now, F.lit(stamp))
                self._listings.replace(enriched)
                self._logged(visits, stamp)
        return text

    def stats(self) -> DataFrame:
        return reporting.stats(self.listings, self.page_log)

    def export(self, path: str, **options: Any) -> int:
        return writers.export(self.listings, path, **options)
