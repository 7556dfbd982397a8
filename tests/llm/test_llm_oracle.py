"""Registered queries against DuckDB, where SQL can express them."""

import pytest

import __spark_entry__ as entry
from compare import compare, oracle
from runlens.llm.oracle import SQL
from runlens.llm.queries import QUERIES


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert QUERIES.items() <= entry.queries().items() and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), oracle(sf_dir), SQL[name]) > 0
