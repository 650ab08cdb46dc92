"""Column expressions for places."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from .text import clean, strip, title_case

# Fixed value: the words that a district's or town's name may carry.
_SUFFIX = r"(?U)\b(town|city|new town|district)\b"


def _bare(part: Column) -> Column:
    return strip(F.replace(F.lower(part), F.lit(" district"), F.lit("")))


def split_location(text: Column, district: str = dims.DISTRICT, towns: list[str] | None = None) -> Column:
    """struct(town, district) of a comma list, most specific part first."""
    parts = F.filter(F.transform(F.split(clean(text), ","), clean), lambda p: p.isNotNull())
    own = F.lit(district.lower())
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    town = F.when(second.isNotNull() & (_bare(first) == own), second).otherwise(first)
    known = dims.literal_map({t.lower(): t for t in (towns or dims.TOWNS)})
    return F.struct(
        F.coalesce(F.try_element_at(known, _bare(town)), town).alias("town"),
        F.when(F.exists(parts, lambda p: _bare(p) == own), district).alias("district"),
    )


def canonical_town(town: Column) -> Column:
    """One spelling a town; names in Latin letters are capitalised, others stay."""
    name = strip(F.nullif(town, F.lit("")))
    table = dims.literal_map(dims.CANONICAL_TOWNS)
    plain = F.when(name.rlike(r"^[\x00-\x7F]*$"), title_case(name)).otherwise(name)
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.try_element_at(table, name), plain)


def district_of(town: Column) -> Column:
    """The district of an exact town name without its suffix words."""
    key = F.regexp_replace(strip(F.lower(town)), r"(?U)\s+", " ")
    key = F.btrim(F.regexp_replace(key, _SUFFIX, ""), F.lit(" ,-"))
    return F.try_element_at(dims.literal_map({t: d for _, t, d in dims.towns_by_rank()}), key)


def _firsts(names: list[str]) -> str:
    return "".join(dict.fromkeys(n[0] for n in names))


def _by_first(names: list[str]) -> str:
    """Alternatives by their first letter. Of those that fit at a place, the first is the same."""
    return "|".join(f + "(?:" + "|".join(n[1:] for n in names if n[0] == f) + ")" for f in _firsts(names))


def _spelling(town: str) -> str:
    """``canonical_town`` of a name of the gazetteer, which are lower-cased and stripped."""
    words = "".join(w[:1].upper() + w[1:] for w in re.split(r"(?<=[^a-z])", town))
    return dims.CANONICAL_TOWNS.get(town) or (words if town.isascii() else town)


def find_town(text: Column) -> Column:
    """struct(town, district): the longest town named anywhere in a text, then the first listed.

    One pass a script: an overlapping match yields, at each place, the longest town there.
    Latin names need word boundaries; other scripts add case suffixes, so any substring counts.
    """
    table = dims.towns_by_rank()
    latin = [re.escape(t).replace(r"\ ", " ").replace(r"\-", "-") for _, t, _ in table if t.isascii()]
    other = [t for _, t, _ in table if not t.isascii()]
    hits = F.concat(
        F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)(?=[{_firsts(latin)}])(?=\b({_by_first(latin)})\b)"), F.lit(1)),
        F.regexp_extract_all(text, F.lit(f"(?=[{_firsts(other)}])(?=({_by_first(other)}))"), F.lit(1)),
    )
    rank = F.create_map(*[F.lit(x) for i, t, _ in table for x in (t, i)])
    best = F.array_min(F.transform(hits, lambda t: F.try_element_at(rank, t)))
    towns = F.array(*[F.lit(_spelling(t)) for _, t, _ in table])
    districts = F.array(*[F.lit(d) for _, _, d in table])
    return F.struct(F.get(towns, best).alias("town"), F.get(districts, best).alias("district"))
