"""Column expressions for prices and sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims
from .text import empty_to_null, strip

# The number patterns, and phrases for prices that are none.
PRICE = r"(?iU)(Rs\.?|LKR|රු\.?)?\s*(\d[\d,\s]*(?:\.\d+)?)"
NUMBER = r"(?U)(\d[\d,]*(?:\.\d+)?)"
ASK = ["ask for price", "negotiable price", "on request"]


def _any(text: Column, phrases: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def parse_price(text: Column) -> Column:
    """struct(value, currency, qualifier) of a price as it is shown."""
    text = empty_to_null(text)
    low = F.lower(text)
    qualifier = F.coalesce(*[F.when(F.contains(low, F.lit(q)), F.lit(q.title())) for q in dims.PRICE_QUALIFIERS])
    free = F.contains(low, F.lit("free")) & ~text.rlike(r"(?U)\d")
    ask = _any(low, ASK)
    digits = F.regexp_replace(F.regexp_extract(text, PRICE, 2), "[, ]", "")
    value = strip(digits).try_cast("double")
    marked = (F.regexp_extract(text, PRICE, 1) != "") | F.contains(low, F.lit("rs")) | F.contains(low, F.lit("lkr"))
    none = F.lit(None)
    return F.struct(
        F.when(free, 0.0).when(ask, none).otherwise(value).alias("value"),
        F.when(free, "LKR").when(~ask & value.isNotNull() & marked, "LKR").alias("currency"),
        F.when(free, F.coalesce(qualifier, F.lit("Free"))).when(ask, F.coalesce(qualifier, F.lit("Ask for price"))).otherwise(qualifier).alias("qualifier"),
    )


def _number(text: Column) -> Column:
    return F.replace(F.regexp_extract(text, NUMBER, 1), F.lit(","), F.lit("")).try_cast("double")


def parse_size(text: Column) -> Column:
    """struct(perches, unit) of a land size; units that aren't known keep the number."""
    low, n = F.lower(text), _number(text)
    acres = F.contains(low, F.lit("acre"))
    perches = F.contains(low, F.lit("perch")) | F.endswith(strip(low), F.lit("p"))
    sqm = F.contains(low, F.lit("sq")) & F.contains(low, F.lit("m"))
    return F.struct(
        F.when(acres, n * dims.PERCHES_PER_ACRE).when(perches, n).when(sqm, n / dims.SQM_PER_PERCH).otherwise(n).alias("perches"),
        F.when(n.isNull(), None).when(acres, "acres").when(perches, "perches").when(sqm, "sqm").alias("unit"),
    )


def parse_price_basis(text: Column) -> Column:
    """struct(amount, basis): what a price is quoted per."""
    low, n = F.lower(text), _number(text)
    basis = F.when(n.isNull(), None)
    for word in ("perch", "acre", "total"):
        basis = basis.when(F.contains(low, F.lit(word)), word)
    return F.struct(n.alias("amount"), basis.alias("basis"))


def totals(amount: Column, basis: Column, perches: Column) -> Column:
    """struct(total, per_perch). A basis that isn't stated means a total; a size of zero is unknown."""
    size = F.nullif(perches, F.lit(0.0))
    total = F.when(basis == "perch", amount * size).when(basis == "acre", amount * (size / dims.PERCHES_PER_ACRE)).otherwise(amount)
    rate = F.when(basis == "perch", amount).when(basis == "acre", amount / dims.PERCHES_PER_ACRE).otherwise(amount / size)
    return F.struct(total.alias("total"), rate.alias("per_perch"))
