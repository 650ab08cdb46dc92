"""Markdown tables to audited listings."""

from pyspark.sql import functions as F

from gleanery.operators import importing, merging
from gleanery.sources import markdown

TEXT = """words before
| Title | Size | Location Listed | Price | Link |
|:---|---|---|---|---|
| Land at Kuruwita | 10 perches | Ratnapura | Rs 200,000 / perch | a |
| Land at Kuruwita | 10 perches | Ratnapura | Rs 2,000,000 / perch | a |
| Land at Kuruwita | 10 perches | Ratnapura | Rs 200,000 / perch | b |
| Nice | plot in Colombo | 1 acre | Ratnapura | Rs 5,000,000 | c |
| 2 acres at Galle | 20 perches | Galle | Rs 90 / perch |
|  | 1 acre | Galle | Rs 1 | x |
words between
| Advert | Location | Extent | Asking Price |
| --- | --- | --- | --- |
| Kandy land | Kandy | 2 acres | Rs 100,000 / perch |
"""


def imported(spark, text=TEXT):
    texts = spark.createDataFrame([("d", text)], "doc string, text string")
    return importing.audit(importing.normalise(markdown.table_rows(texts)))


def test_rows(spark):
    rows = {r["line"]: r for r in imported(spark).collect()}
    assert len(rows) == 6
    assert rows[6]["title"] == "Nice | plot in Colombo" and rows[6]["town"] == "Colombo" and rows[6]["district_source"] == "title"
    assert rows[6]["flags"] == ["price-basis-unstated", "location-mismatch:listed-Ratnapura-actually-Colombo"]
    assert rows[4]["flags"] == ["per-perch-high-for-district", "price-conflicts-with-duplicate"]
    assert rows[7]["flags"] == ["per-perch-implausibly-low", "size-unit-conflicts-with-title"]
    assert [r["source_table"] for r in rows.values()].count("2") == 1
    last = rows[max(rows)]
    assert (last["size_perches"], last["price_total"], last["district"]) == (320.0, 32_000_000.0, "Kandy")


def test_conflicts_and_summary(spark):
    rows = imported(spark)
    found = importing.conflicts(rows).collect()
    assert [(r["title"], r["median_total"], len(r["variants"])) for r in found] == [("land at kuruwita", 2_000_000.0, 2)]
    summary = {(r["section"], r["key"]): r["n"] for r in importing.summary(rows).collect()}
    assert summary["total", "rows_parsed"] == 6 and summary["total", "duplicate_rows"] == 1 and summary["flag", "location-mismatch"] == 1


def test_no_table(spark):
    assert imported(spark, "no table\n| only | a pipe |").count() == 0


def test_import_is_idempotent(spark):
    rows = importing.to_listing(imported(spark), F.lit("2026-01-01T00:00:00+00:00")).withColumn("seq", F.monotonically_increasing_id()).cache()
    once = merging.fold(rows)
    again = merging.upsert(once, rows)
    assert once.count() == 5
    assert sorted(map(str, again.select("listing_id", "title", "price_value").collect())) == sorted(map(str, once.select("listing_id", "title", "price_value").collect()))


def test_a_long_document_is_dealt_out(spark, monkeypatch):
    table = "| Title | Size | Price |\n|---|---|---|\n" + "".join(f"| Lot {i} | {i} perches | Rs 5 |\n" for i in range(40))
    other = "| Name | Asking price | Extent |\n|---|---|---|\n" + "".join(f"| Plot {i} | Rs 7 | {i} perches |\n" for i in range(40))
    texts = spark.createDataFrame([("d", "| stray | x |\n" + table + "\n" + other), (None, other)], "doc string, text string")
    columns = ["doc", "line", "source_table", *markdown.ROLES]
    whole = sorted(map(str, markdown.table_rows(texts).select(*columns).collect()))
    monkeypatch.setattr(markdown, "STRETCH", 7)
    rows = markdown.table_rows(texts).select(*columns)
    assert sorted(map(str, rows.collect())) == whole and len(whole) == 120
    assert {(r["doc"], r["source_table"], r["price"]) for r in rows.collect()} == {("d", "1", "Rs 5"), ("d", "2", "Rs 7"), (None, "1", "Rs 7")}


def test_places_are_found_once(spark):
    rows = spark.createDataFrame([("Land at Kuruwita", "5 perches", "Rs 9 / perch", "Galle", "1"), ("ඇඹිලිපිටිය x", None, None, None, "1")], "title string, size string, price string, location string, source_table string")
    plan = importing.flagged(importing.normalise(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 8  # two scripts, two texts, two fields
    assert [tuple(r) for r in importing.normalise(rows).select("town", "district", "size_perches", "price_total").collect()] == [("Kuruwita", "Ratnapura", 5.0, 45.0), ("Embilipitiya", "Ratnapura", None, None)]
