"""The keyed fold."""

from gleanery.operators import merging


def observed(spark, *rows):
    names = ["listing_id", "url", "title", "price_value", "is_promoted", "scraped_at", "attributes", "image_urls", "seq"]
    kinds = "listing_id string, url string, title string, price_value double, is_promoted boolean, scraped_at string, attributes map<string,string>, image_urls array<string>, seq long"
    return merging.complete(spark.createDataFrame([tuple(r.get(n, "k" if n == "listing_id" else None) for n in names) for r in rows], kinds), keep=["seq"])


def test_known_values_are_not_blanked(spark):
    rows = observed(
        spark,
        {"url": "u", "title": "first", "price_value": 5.0, "is_promoted": True, "scraped_at": "t1", "attributes": {"a": "1", "b": "2"}, "image_urls": ["x", "x"], "seq": 1},
        {"url": "u", "title": "", "price_value": 0.0, "is_promoted": False, "scraped_at": "t2", "attributes": {"b": "3"}, "image_urls": ["y", "x"], "seq": 2},
    )
    got = merging.fold(rows).first()
    assert (got["title"], got["price_value"], got["is_promoted"], got["scraped_at"]) == ("first", 5.0, False, "t1")
    assert got["attributes"] == {"a": "1", "b": "3"} and got["image_urls"] == ["x", "x", "y"]


def test_a_first_zero_is_kept(spark):
    assert merging.fold(observed(spark, {"url": "u", "price_value": 0.0, "seq": 1})).first()["price_value"] == 0.0


def test_keyed_on_id_not_url(spark):
    rows = observed(spark, {"url": "/en/ad/a?x=1", "title": "a", "seq": 1}, {"url": "/en/ad/a", "seq": 2})
    assert merging.fold(rows).count() == 1


def test_folds_of_folds_are_the_fold(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from gleanery.streaming import FoldingSink

    rng = random.Random(4)
    rows = [
        {"listing_id": f"k{rng.randrange(3)}", "url": f"u{i}", "title": rng.choice(["", None, f"t{i}"]), "price_value": rng.choice([None, 0.0, float(i)]), "is_promoted": bool(i % 2),
         "scraped_at": f"t{i:02}", "attributes": {rng.choice("abc"): str(i)}, "image_urls": rng.choices("xyz", k=rng.randrange(4)), "seq": i}
        for i in range(40)
    ]
    whole = observed(spark, *rows)
    sink = FoldingSink(spark, str(tmp_path))
    sink.COMPACT = 3
    for batch in [0, 1, 2, 2, 3, 4]:
        sink(whole.where(F.col("seq").between(batch * 8, batch * 8 + 7)), batch)
    assert sorted(p.name for p in tmp_path.glob("base-*")) == ["base-2"]

    def told(df):
        return sorted(str(r.asDict()) for r in df.select(*[c for c in merging.ROW_COLUMNS if c != "attributes"], F.array_sort(F.map_entries("attributes")).alias("a")).collect())

    assert told(sink.current()) == told(merging.fold(whole))


def test_large_dimensions_are_looked_up_by_index(spark, monkeypatch):
    from gleanery.operators import lookups

    names = [("ab", 3), ("abc", 2), ("abcd", 1), ("xbcd", 0), ("abcdef", 5), ("é", 4), ("", 6)]
    dimension = spark.createDataFrame(names, "name string, at int")
    rows = spark.createDataFrame([(t,) for t in ("zabz", "abcdxbcd", "1abcdef", "caf\u00e9", "none", None, "", "a\nb abc")], "t string")

    def found():
        return sorted(map(str, lookups.theta_lookup(rows, "t", dimension, "name", "at").collect()))

    small = found()
    monkeypatch.setattr(lookups, "MOST_LITERALS", 2)
    assert found() == small and "found='xbcd'" in str(small)
