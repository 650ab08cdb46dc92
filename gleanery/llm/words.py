"""Column expressions shared by the operators on words.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def as_text(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    return F.filter(F.split(as_text(text), SPACE + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")
