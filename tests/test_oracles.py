"""Every registered query against its SQL, row by row."""

import pytest

from verify import compare
from verify.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    problem, rows, _ = compare.compare(spark, con, name, QUERIES[name], sf)
    assert problem is None, problem
    assert rows > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
