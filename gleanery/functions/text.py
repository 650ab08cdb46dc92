"""Column expressions on text, URLs and identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What counts as white space in a text of any script.
WS = r"(?U)[\s\x1c-\x1f]"

# The shape of an advert's path and of a build hash at the end of a class name.
AD_PATH = r"^/(?:en|si|ta)/ad/[^/?#]+/?$"
CLASS_HASH = r"(--|___?)[A-Za-z0-9_-]{4,}$"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def computed(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``rows`` with ``columns``, each computed once a row: the optimizer writes plain ones out for each use
    of each field, and again into filters on what is made of them. It doesn't reach through a generator."""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select("*", F.explode(F.array(made)).alias("_made")).select(*rows.columns, "_made.*")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def clean(c: Column) -> Column:
    """White space collapsed and trimmed; null for what is then empty."""
    return empty_to_null(F.trim(F.regexp_replace(c, WS + "+", " ")))


def title_case(c: Column) -> Column:
    """Every run of letters capitalised, after hyphens and quotes too."""
    return F.array_join(F.transform(F.split(F.lower(c), "(?<=[^a-z])"), F.initcap), "")


def slugify(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def url_path(url: Column) -> Column:
    """A URL without scheme, host, query string and trailing slashes."""
    path = F.regexp_replace(F.substring_index(url, "?", 1), r"^https?://[^/]+", "")
    return F.rtrim(path, F.lit("/"))


def listing_id(url: Column) -> Column:
    return F.substring(F.sha1(url_path(url)), 1, 16)


def is_ad_url(url: Column) -> Column:
    """Whether the path, of an absolute or a relative URL, is an advert's."""
    path = F.regexp_replace(F.substring_index(F.substring_index(url, "#", 1), "?", 1), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return path.rlike(AD_PATH)


def attribute_column(key: Column) -> Column:
    return F.concat(F.lit("attr_"), F.lower(F.replace(F.trim(key), F.lit(" "), F.lit("_"))))


def flag_kind(flag: Column) -> Column:
    return F.substring_index(flag, ":", 1)


def stable_class(name: Column) -> Column:
    """A class name without the build hash, unless nothing else is left."""
    return F.coalesce(empty_to_null(F.regexp_replace(name, CLASS_HASH, "")), name)


def float_text(x: Column) -> Column:
    """A double in plain digits, with one decimal at least; ``None`` for null."""
    plain = F.regexp_replace(x.try_cast("decimal(38,15)").cast("string"), "0+$", "")
    return F.coalesce(F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain), F.lit("None"))


def row_key(title: Column, size: Column, amount: Column) -> Column:
    """Identity of an imported advert, whatever paste it came from."""
    basis = F.concat_ws("|", F.lower(strip(title)), float_text(size), float_text(amount))
    return F.substring(F.sha1(basis), 1, 16)


def search_url(base: Column, template: Column, locale: Column, location: Column, category: Column, page: Column, param: str = "page") -> Column:
    """A result page's URL from a path template; pages after the first carry a parameter."""
    path = template
    for name, value in (("{locale}", locale), ("{location}", location), ("{category}", F.coalesce(category, F.lit("")))):
        path = F.replace(path, F.lit(name), value)
    url = F.concat(F.rtrim(base, F.lit("/")), path)
    return F.when(page > 1, F.concat(url, F.lit(f"?{param}="), page.cast("string"))).otherwise(url)


def page_number(url: Column, param: str = "page") -> Column:
    """The page parameter of a URL, 1 where it has none."""
    found = F.regexp_extract(url, rf"[?&]{param}=(\d+)", 1)
    return F.coalesce(found.try_cast("int"), F.lit(1))
