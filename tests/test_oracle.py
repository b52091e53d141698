"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

QUERIES = entry.queries()
SQL = entry.oracle_sql()
# thresholds the smallest tables never reach; checked at the next scale
MAY_BE_EMPTY = {"a12_frequent"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        problems = compare(df, con, SQL[name])
    else:
        problems = [] if df.count() else ["empty result"]
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "empty result"]
    assert not problems


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
