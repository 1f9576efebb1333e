"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import connect, difference
from conftest import SMALL

import catalog


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, tables, name):
    frame = catalog.QUERIES[name](spark, SMALL)
    assert difference(frame, tables, catalog.SQL[name]) is None


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
