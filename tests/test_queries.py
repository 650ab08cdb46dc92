"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from gleanery.plans import registry


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, sf_dir, same, name):
    same(registry.queries()[name](spark, sf_dir), registry.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_of_the_engine_has_sql():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
