"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.columns
        return
    assert difference(result, con, sql) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2
