"""Joins of a table of any size with a table of groups, safe for hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Group tables of up to this many rows are broadcast; their size is counted first.
BROADCAST_ROWS = 100_000
SALTS = 32
#: Groups of more rows than this are joined apart from the others.
HOT = 10_000


def attach(left: DataFrame, groups: DataFrame, on: list[str], salt: Column) -> DataFrame:
    """Left join on non-null columns ``on``. A small ``groups`` is broadcast; a larger one
    is repeated ``SALTS`` times and joined on a salt too, so that a hot group's rows are
    spread over that many tasks."""
    if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(groups), on, "left")
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int"))
    repeated = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "__salt"], "left").drop("__salt")


def join_counted(left: DataFrame, groups: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner join on non-null columns ``on`` with groups that know how many rows of ``left`` they
    have. Hot groups are few for the rows they have: their number is counted, and they are
    broadcast, so that their rows stay where they are. The others are joined by key."""
    hot = groups.where(F.col(count) > HOT)
    if not 0 < hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return left.join(groups, on)
    cold = left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups.where(F.col(count) <= HOT), on)
    return left.join(F.broadcast(hot), on).unionByName(cold)
