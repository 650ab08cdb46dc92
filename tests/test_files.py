"""Exports, settings, raw pages, the command line."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

import gleanery
from gleanery import cli
from gleanery.operators import merging
from gleanery.sources import tables, writers
from gleanery.sources.config import Settings, read_settings, write_settings
from gleanery.sources.snapshots import Snapshots


@pytest.fixture
def listings(spark):
    rows = [("a", "/en/ad/a", "ඉඩම, \"x\"", {"Land Size": '"10"', "beds": "3"}, ["i", "j"], True), ("b", "/en/ad/b", None, {"Mileage": "12"}, [], False)]
    kinds = "listing_id string, url string, title string, attributes map<string,string>, image_urls array<string>, is_promoted boolean"
    return merging.complete(spark.createDataFrame(rows, kinds)).withColumn("detail_fetched", F.lit(0))


def test_csv(listings, tmp_path):
    assert writers.export(listings, tmp_path / "x.csv") == 2
    raw = (tmp_path / "x.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf")
    header, first, _ = raw.decode("utf-8-sig").split("\r\n")[:3]
    assert header.endswith("scraped_at,attr_beds,attr_land_size,attr_mileage") and '"ඉඩම, ""x"""' in first and "i | j" in first


def test_empty_csv_has_a_header(listings, tmp_path):
    assert writers.to_csv(listings.limit(0), tmp_path / "e.csv") == 0
    assert (tmp_path / "e.csv").read_text("utf-8-sig").startswith("listing_id,url,title")


def test_jsonl(listings, tmp_path):
    writers.export(listings, tmp_path / "x.jsonl")
    first = json.loads((tmp_path / "x.jsonl").read_text("utf-8").splitlines()[0])
    assert first["attributes"] == {"Land Size": "10", "beds": 3} and list(first)[-1] == "listing_id"


def test_excel(listings, tmp_path):
    writers.export(listings, tmp_path / "x.xlsx")
    sheet = zipfile.ZipFile(tmp_path / "x.xlsx").read("xl/worksheets/sheet1.xml").decode()
    assert sheet.count("<row>") == 3 and 'topLeftCell="A2"' in sheet


def test_unknown_suffix(listings, tmp_path):
    with pytest.raises(ValueError):
        writers.export(listings, tmp_path / "x.txt")


def test_round_trip(listings):
    back = tables.decode(tables.encode(listings)).orderBy("listing_id").collect()
    assert back[0]["attributes"] == {"Land Size": '"10"', "beds": "3"} and back[0]["image_urls"] == ["i", "j"] and back[1]["is_promoted"] is False


def test_settings(tmp_path):
    write_settings(Settings(locale="si"), tmp_path / "a" / "c.json")
    data = json.loads((tmp_path / "a" / "c.json").read_text()) | {"unknown": 1}
    (tmp_path / "c.json").write_text(json.dumps(data))
    got = read_settings(tmp_path / "c.json")
    assert got["locale"] == "si" and dict(got) == dict(Settings(locale="si")) and "unknown" not in got
    with pytest.raises(TypeError):
        Settings(unknown=1)


def test_snapshots_are_swapped(spark, tmp_path):
    kept = Snapshots(spark, str(tmp_path / "t"))
    assert kept.current() is None
    for n in range(4):
        old = kept.current()
        kept.replace(spark.range(1) if old is None else old.selectExpr("id + 1 AS id"))
        assert [r["id"] for r in kept.current().collect()] == [n]
    assert len(list((tmp_path / "t").glob("snapshot-*"))) == 2


def test_raw_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>a</p>")
    (tmp_path / "a.url").write_text("https://x.example/a")
    tables.register(spark)
    assert [tuple(r) for r in spark.read.format("raw_pages").load(str(tmp_path)).collect()] == [("https://x.example/a", 200, "<p>a</p>", True)]


def test_saved_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>a</p>\n<p>b</p>")
    (tmp_path / "a.url").write_text("https://x.example/a\n")
    (tmp_path / "b.html").write_text("")
    rows = {r["url"]: r["html"] for r in tables.saved_pages(spark, str(tmp_path)).collect()}
    assert rows["https://x.example/a"] == "<p>a</p>\n<p>b</p>" and sum(u.endswith("/b") for u in rows) == len(rows) - 1


def test_too_many_attributes_stay_json(listings, monkeypatch):
    monkeypatch.setattr(writers, "MOST_COLUMNS", 2)
    assert writers.flatten(listings).columns[-5:] != [] and "attributes" in writers.flatten(listings).columns


def test_command_line(spark, tmp_path, capsys):
    md, db = tmp_path / "t.md", str(tmp_path / "db")
    md.write_text("| Title | Size | Price | Location |\n|---|---|---|---|\n| Land at Galle | 5 perches | Rs 90,000 / perch | Galle |\n")
    assert cli.main(["--db", db, "import-table", str(md)]) == 0
    assert cli.main(["--db", db, "import-table", str(md)]) == 0
    assert "imported 0 new, 1 merged" in capsys.readouterr().out
    assert cli.main(["--db", db, "export", "--out", str(tmp_path / "o.csv")]) == 0
    assert cli.main(["--db", db, "export", "--out", str(tmp_path / "o.bad")]) == 2
    assert cli.main(["--db", str(tmp_path / "none"), "export"]) == 1
    assert cli.main(["--db", db, "stats"]) == 0
    assert cli.main(["towns"]) == 0


def test_crawl_command(spark, tmp_path, capsys):
    site, config, db = tmp_path / "site", tmp_path / "c.json", str(tmp_path / "db")
    site.mkdir()
    write_settings(Settings(base_url="https://x.example", categories=["vehicles"], max_pages_per_query=1, towns=["Balangoda"]), config)

    def save(name, url, body):
        (site / f"{name}.html").write_text(f"<html><body>{body}</body></html>")
        (site / f"{name}.url").write_text(url)

    save("s", "https://x.example/en/ads/ratnapura", "<div><p><a href='/en/ad/a'>An advert of some length</a></p><p>2 days ago</p></div>")
    save("v", "https://x.example/en/ads/ratnapura/vehicles", "<div><p><a href='/en/ad/b'>Another advert of some length</a></p></div>")
    save("t", "https://x.example/en/ads/balangoda/vehicles", "<div><p><a href='/en/ad/c'>A third advert of some length</a></p></div>")
    save("d", "https://x.example/en/ad/a", "<h1>A title</h1><div class='description'>All about it</div>")
    assert cli.main(["--db", db, "crawl", str(site), "--config", str(config)]) == 0
    assert "3 pages, 3 new listings" in capsys.readouterr().out
    engine = gleanery.Engine(db, spark=spark)
    rows = {r["url"].rsplit("/", 1)[1]: r for r in engine.listings.collect()}
    assert rows["a"]["title"] == "A title" and rows["a"]["posted_text"] == "2 days ago" and rows["a"]["detail_fetched"] == 1
    assert rows["c"]["category"] == "vehicles" and rows["c"]["detail_fetched"] == 0 and engine.page_log.count() == 4
    assert cli.main(["--db", db, "crawl", str(site), "--config", str(config)]) == 0
    assert "0 pages, 0 new listings" in capsys.readouterr().out


def test_discover_command(spark, tmp_path, capsys):
    (tmp_path / "a.html").write_text("<ul><li class='ad-card--x9y8z'><a href='/en/ad/a'>An advert of some length</a><a href='/en/ads/ratnapura/boats'>b</a></li></ul>")
    assert cli.main(["discover", str(tmp_path), "--config", str(tmp_path / "c.json"), "--report", str(tmp_path / "r" / "d.json")]) == 0
    report = json.loads((tmp_path / "r" / "d.json").read_text())
    assert report["strategies"] and report["card_candidates"][0]["selector"] == "li[class*='ad-card']"
    assert read_settings(tmp_path / "c.json")["learned_selectors"]["card"] == "li[class*='ad-card']"


def test_public_names():
    assert set(gleanery.__all__) <= {*dir(gleanery), *gleanery._HOMES} and gleanery.Settings()["locale"] == "en" and gleanery.LISTING.names[0] == "listing_id"


def test_no_row_passes_through_the_driver(listings, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from gleanery.plans import exporting

    def refused(*_):
        raise AssertionError("rows are sent to the driver")

    rows = listings.withColumns({"town": F.lit('a "b", c\\'), "price_value": F.when(F.col("listing_id") == "a", 1.5)}).unionByName(
        listings.limit(1).withColumns({"listing_id": F.lit("c"), "title": F.lit(" two\nlines <&> "), "attributes": F.create_map(F.lit("Key 1"), F.lit('"v"'))})
    )
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "toLocalIterator", refused)
        for kind in exporting._READERS:
            assert writers.export(rows, f"file://{tmp_path}/sub/x.{kind}") == 3
    shown = {("a", 'ඉඩම, "x"', "1.5", 'a "b", c\\', ""), ("b", "", "", 'a "b", c\\', ""), ("c", " two\nlines <&> ", "", "", "v")}
    for kind, read in exporting._READERS.items():
        assert {tuple(r) for r in read(rows.sparkSession, f"file://{tmp_path}/sub/x.{kind}").collect()} == shown, kind
