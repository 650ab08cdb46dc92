"""Column expressions for dates as they are shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean

# Units in seconds (a month has 30 days, a year 365) and date formats, in order.
UNITS = {
    "second": 1, "minute": 60, "min": 60, "hour": 3600, "hr": 3600,
    "day": 86400, "week": 7 * 86400, "month": 30 * 86400, "year": 365 * 86400,
}
FORMATS = ["d MMM yyyy", "d MMMM yyyy", "yyyy-M-d", "d/M/yyyy", "MMM d, yyyy"]
# End of the fixed values.

#: What a text must look like at least to be tried: a failed attempt costs an exception.
_SHAPES = [r"^\d+ \S+ [+-]?\d+$", r"^\d+ \S+ [+-]?\d+$", r"^[+-]?\d+-\d+-\d+$", r"^\d+/\d+/[+-]?\d+$", r"^\S+ \d+, [+-]?\d+$"]
ISO = "yyyy-MM-dd'T'HH:mm:ssxxx"
_AGO = r"(?U)(\d+)\s*(second|minute|min|hour|hr|day|week|month|year)s?\s*ago"
#: Ages beyond this many seconds are no ages of adverts.
_OLDEST = 2000 * UNITS["year"]


def iso(ts: Column) -> Column:
    """ISO-8601 to the second; the session's zone must be UTC."""
    return F.date_format(ts, ISO)


def parse_posted(text: Column, now: Column) -> Column:
    """ISO-8601 text of a relative or absolute date, anchored at ``now``; null for anything else."""
    whole = clean(text)
    low = F.lower(whole)
    day = F.date_trunc("day", now)
    seconds = F.regexp_extract(low, _AGO, 1).try_cast("bigint")
    unit = F.regexp_extract(low, _AGO, 2)
    size = F.coalesce(*[F.when(unit == name, F.lit(n)) for name, n in UNITS.items()])
    age = F.when(seconds <= _OLDEST / size, seconds * size)
    relative = F.timestamp_seconds(F.unix_timestamp(now) - age)
    absolute = F.coalesce(*[F.when(whole.rlike(shape), F.try_to_timestamp(whole, F.lit(f))) for f, shape in zip(FORMATS, _SHAPES, strict=True)])
    return iso(
        F.when(low.rlike("just now|moments ago"), now)
        .when(F.contains(low, F.lit("today")), day)
        .when(F.contains(low, F.lit("yesterday")), day - F.expr("INTERVAL 1 DAY"))
        .when(unit != "", relative)
        .otherwise(absolute)
    )
