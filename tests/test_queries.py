"""Every registered query equals its DuckDB twin on the given tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from factlake.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_twin(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, con, entry.oracle_sql()[name]) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
