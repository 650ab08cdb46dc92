"""Command line: import-table, extract, crawl, export, stats, discover, towns."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import dims
from .engine import Engine
from .operators import choosing, discovery, importing, merging
from .session import session
from .sources import markdown, pages, tables, writers
from .sources.config import Settings, read_settings, write_settings


def _engine(spark: SparkSession, args: argparse.Namespace) -> Engine:
    return Engine(args.db, read_settings(args.config) if getattr(args, "config", None) else None, spark)


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def import_table(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = importing.audit(importing.normalise(markdown.table_rows(markdown.read_texts(spark, args.path)))).persist()
    if rows.isEmpty():
        print(f"no table rows found in {args.path}", file=sys.stderr)
        return 1
    kept = rows.where(F.col("district") == args.only_district) if args.only_district else rows
    listings = importing.to_listing(kept, F.lit(_now()))
    incoming = listings.withColumns({"seq": F.monotonically_increasing_id(), "detail_fetched": F.lit(0)}).persist()
    new, updated = _engine(spark, args).upsert(incoming)
    for row in importing.summary(rows).orderBy("section", F.desc("n"), "key").toLocalIterator():
        print(f"{row['section']}\t{row['key']}\t{row['n']}")
    print(f"imported {new} new, {updated} merged into existing -> {args.db}")
    for row in importing.conflicts(rows).toLocalIterator():
        print(f"  {row['title'][:60]} -> {', '.join(row['variants'])}")
    return 0


def extract(spark: SparkSession, args: argparse.Namespace) -> int:
    engine = _engine(spark, args)
    found = pages.to_listings(
        pages.reads(tables.saved_pages(spark, args.folder), args.details, engine.settings["learned_selectors"]), F.current_timestamp(), F.lit(_now())
    ).persist()
    best = choosing.merge_details(found) if args.details else choosing.best_reads(found)
    extra = {"seq": F.monotonically_increasing_id(), "detail_fetched": F.lit(int(args.details))}
    if args.details:
        best = best.withColumn("listing_id", pages.listing_id(F.col("url")))
    new, updated = engine.upsert(merging.complete(best).withColumns(extra).persist())
    print(f"{new} new, {updated} merged into existing -> {args.db}")
    return 0


def crawl(spark: SparkSession, args: argparse.Namespace) -> int:
    engine = _engine(spark, args)
    print(engine.crawl(tables.saved_pages(spark, args.folder), False if args.no_details else None, lambda message: print(message, file=sys.stderr)))
    return 0


def export(spark: SparkSession, args: argparse.Namespace) -> int:
    listings = _engine(spark, args).listings
    if listings.isEmpty():
        print("nothing to export; the table is empty", file=sys.stderr)
        return 1
    try:
        n = writers.export(listings, args.out, not args.no_flatten, args.district)
    except ValueError as bad:
        print(bad, file=sys.stderr)
        return 2
    print(f"wrote {n} listings to {args.out}")
    return 0


def stats(spark: SparkSession, args: argparse.Namespace) -> int:
    for row in _engine(spark, args).stats().toLocalIterator():
        print(f"{row['section']}\t{row['key']}\t{row['n']}")
    return 0


def discover(spark: SparkSession, args: argparse.Namespace) -> int:
    report = discovery.report(tables.saved_pages(spark, args.folder).persist())
    cards = report["card_candidates"]
    write_settings(Settings(categories=report["categories"], learned_selectors={"card": cards[0]["selector"]} if cards else {}), args.config)
    told = json.dumps(report, indent=2, ensure_ascii=False)
    Path(args.report).parent.mkdir(parents=True, exist_ok=True)
    Path(args.report).write_text(told, encoding="utf-8")
    print(told)
    return 0 if report["strategies"] else 1


def towns(spark: SparkSession | None, args: argparse.Namespace) -> int:
    print("\n".join(dims.TOWNS))
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gleanery")
    top.add_argument("--db", default="data/listings", help="folder of the listing table and the page log")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, *options: tuple[str, dict]) -> None:
        p = sub.add_parser(name.replace("_", "-"))
        for flag, more in options:
            p.add_argument(flag, **more)
        p.set_defaults(run=run)

    add("import_table", import_table, ("path", {}), ("--only-district", {}))
    add("extract", extract, ("folder", {}), ("--details", {"action": "store_true"}), ("--config", {}))
    add("export", export, ("--out", {"default": "out/listings.csv"}), ("--no-flatten", {"action": "store_true"}), ("--district", {}))
    add("stats", stats)
    add("crawl", crawl, ("folder", {}), ("--no-details", {"action": "store_true"}), ("--config", {}))
    add("discover", discover, ("folder", {}), ("--config", {"default": "data/config.json"}), ("--report", {"default": "data/discovery.json"}))
    add("towns", towns)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(None if args.run is towns else session("gleanery"), args)


if __name__ == "__main__":
    raise SystemExit(main())
