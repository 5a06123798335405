"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry_points
from basketlens import registry
from compare import difference, open_tables

# Queries on the sales tables; those of the optional text operators have tests of their own.
KEYS = sorted(registry.catalogue())


def test_every_query_has_check_sql():
    assert set(registry.catalogue()) == set(registry.check_sql())
    assert set(KEYS) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.fixture(scope="module")
def con(folder):
    return open_tables(folder)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, folder, con, key):
    df = entry_points.queries()[key](spark, folder)
    assert difference(df, con, entry_points.oracle_sql()[key]) is None


def test_entry_has_rows_and_schema(spark, folder):
    df = entry_points.entry(spark)
    assert df.columns[0] == "year_month"
    assert df.count() > 0
