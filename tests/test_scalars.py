"""Case tables of the scalar functions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanery.functions import dates, money, places, text


def values(spark, cases, f):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    out = rows.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()
    return [tuple(r["x"]) if hasattr(r["x"], "asDict") else r["x"] for r in out]


def check(spark, f, table):
    assert values(spark, list(table), f) == list(table.values())


def test_price(spark):
    check(spark, money.parse_price, {
        "Rs 2,500,000": (2500000.0, "LKR", None), "Rs. 45000": (45000.0, "LKR", None), "LKR 1,200 per month": (1200.0, "LKR", "Per Month"),
        "2,500,000": (2500000.0, None, None), "Free": (0.0, "LKR", "Free"), "Ask for price": (None, None, "Ask for price"),
        "": (None, None, None), "Rs 25,000 Negotiable": (25000.0, "LKR", "Negotiable"), "soon": (None, None, None),
        "Rs 385,000 3 beds": (3850003.0, "LKR", None), "Negotiable price": (None, None, "Negotiable"), "7 offers": (7.0, "LKR", None),
    })


def test_size_and_basis(spark):
    check(spark, money.parse_size, {
        "10 perches": (10.0, "perches"), "1.5 Acres": (240.0, "acres"), "2,529.29 sq m": (100.0, "sqm"), "15p": (15.0, "perches"), "20": (20.0, None), "x": (None, None),
    })
    check(spark, money.parse_price_basis, {
        "Rs 200,000 / perch": (200000.0, "perch"), "Rs 5 total": (5.0, "total"), "1 per acre": (1.0, "acre"), "Rs 5": (5.0, None), "acre": (None, None),
    })


def test_posted(spark):
    now = F.lit("2026-07-01 12:34:56").cast("timestamp")
    check(spark, lambda c: dates.parse_posted(c, now), {
        "2 days ago": "2026-06-29T12:34:56+00:00", "Yesterday": "2026-06-30T00:00:00+00:00", "today": "2026-07-01T00:00:00+00:00", "Just now": "2026-07-01T12:34:56+00:00",
        "3 hrs ago": "2026-07-01T09:34:56+00:00", "1 month ago": "2026-06-01T12:34:56+00:00", "12 Jan 2026": "2026-01-12T00:00:00+00:00", "12 January 2026": "2026-01-12T00:00:00+00:00",
        "2026-01-12": "2026-01-12T00:00:00+00:00", "12/01/2026": "2026-01-12T00:00:00+00:00", "Jan 12, 2026": "2026-01-12T00:00:00+00:00", "  ": None, "soon": None,
        "99999999999999999999 days ago": None,
    })


def test_places(spark):
    check(spark, places.split_location, {
        "Pelmadulla, Ratnapura": ("Pelmadulla", "Ratnapura"), "Ratnapura District, pelmadulla": ("Pelmadulla", "Ratnapura"), "Colombo": ("Colombo", None),
        "Ratnapura": ("Ratnapura", "Ratnapura"), " , ": (None, None),
    })
    check(spark, places.find_town, {
        "Land in uda kandha near kandy": ("Uda Kandha", "Ratnapura"), "Ja-Ela house": ("Ja-Ela", "Gampaha"), "ballella": (None, None), "Ella land": ("Ella", "Badulla"),
        "එරත්නපුරේ": ("Ratnapura", "Ratnapura"), "abilipitiya plot": ("Embilipitiya", "Ratnapura"), "galle and ella": ("Galle", "Galle"),
    })
    check(spark, places.district_of, {"Kandy District": "Kandy", "  new town ": None, "Ratnapura new town": "Ratnapura", "nowhere": None})


def test_text(spark):
    check(spark, text.clean, {" a  b\n": "a b", " \t": None, "x": "x"})
    check(spark, text.is_ad_url, {"https://x.y/en/ad/abc?x=1": True, "/ta/ad/abc/": True, "/en/ads/abc": False, "/en/ad/a/b": False})
    check(spark, text.slugify, {"Mount Lavinia!": "mount-lavinia", "--": ""})
    check(spark, text.title_case, {"ja-ela": "Ja-Ela", "UDA kandha": "Uda Kandha"})
    ids = values(spark, ["https://a.b/en/ad/x?q=1", "/en/ad/x/", "/en/ad/y"], text.listing_id)
    assert ids[0] == ids[1] != ids[2] and all(len(i) == 16 for i in ids)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=20, max_size=60))
def test_parsers_never_fail(spark, texts):
    texts = [t.replace("\x00", "").encode("utf-8", "ignore").decode() for t in texts] + [None]
    now = F.lit("2026-07-01").cast("timestamp")
    for f in (money.parse_price, money.parse_size, money.parse_price_basis, lambda c: dates.parse_posted(c, now), places.split_location, places.find_town, places.district_of, text.clean):
        assert len(values(spark, texts, f)) == len(texts)


@pytest.mark.parametrize(("x", "shown"), [(8e7, "80000000.0"), (10.5, "10.5"), (0.0, "0.0"), (None, "None")])
def test_float_text(spark, x, shown):
    assert spark.createDataFrame([(x,)], "x double").select(text.float_text(F.col("x")).alias("t")).first()["t"] == shown
