"""Every registered query against its DuckDB oracle, values compared exactly."""

import pytest

from conftest import SF_SMALL
from fundflow.queries import oracle_sql, queries
from oracle_compare import compare, duck

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    sql = oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    problems, _, _ = compare(df, con, sql)
    assert not problems, problems


def test_entry_runs(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0
    assert set(queries()) <= set(entry.oracle_sql()) <= set(entry.queries())
