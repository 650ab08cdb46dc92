"""Row types of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()

#: Export and SQL order of a listing's columns.
ROW_COLUMNS = [
    "listing_id", "url", "title", "price_text", "price_value", "currency",
    "price_qualifier", "category", "subcategory", "location_text", "town",
    "district", "description", "condition", "seller_name", "seller_type",
    "is_promoted", "posted_text", "posted_at", "image_urls", "attributes",
    "source_page", "extracted_by", "scraped_at",
]

_TYPES = {
    "price_value": T.DoubleType(),
    "is_promoted": T.BooleanType(),
    "image_urls": T.ArrayType(_TEXT),
    "attributes": T.MapType(_TEXT, _TEXT),
}

LISTING = T.StructType([T.StructField(c, _TYPES.get(c, _TEXT), c not in ("listing_id", "url")) for c in ROW_COLUMNS])

STORED_LISTING = T.StructType([*LISTING.fields, T.StructField("detail_fetched", T.IntegerType())])


def _rows(**kinds: T.DataType) -> T.StructType:
    """Python workers read these types too, so they are built without a session."""
    return T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])


_INT = T.IntegerType()

PAGES_LOG = _rows(url=_TEXT, kind=_TEXT, status=_INT, listings=_INT, strategy=_TEXT, next_url=_TEXT, error=_TEXT, visited_at=_TEXT)

RUNS_LOG = _rows(id=T.LongType(), started_at=_TEXT, ended_at=_TEXT, config=_TEXT, notes=_TEXT)

#: What a strategy reads off a page, before any value is normalised.
RAW_READ = _rows(
    strategy=_TEXT, strategy_ord=_INT, pos=_INT, url=_TEXT, title=_TEXT, price_text=_TEXT, price_value=T.DoubleType(), currency=_TEXT,
    category=_TEXT, subcategory=_TEXT, location_text=_TEXT, description=_TEXT, condition=_TEXT, is_promoted=T.BooleanType(),
    posted_text=_TEXT, image_urls=T.ArrayType(_TEXT), attributes=T.MapType(_TEXT, _TEXT),
)
