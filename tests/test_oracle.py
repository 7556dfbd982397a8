"""Every registered query gives the rows its SQL gives in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import compare, oracle
from runlens.plans.oracle import oracle_sql
from runlens.plans.queries import QUERIES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) > 0


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 19 and df.count() == 826
