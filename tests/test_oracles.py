"""Every registered query against its SQL in DuckDB, and rules about the registry itself."""

import pytest

import __spark_entry__ as entry
from check import compare, oracle
from tallyspan.plans import all_plans


@pytest.fixture(scope="module")
def duck(tiny):
    return oracle(tiny)


@pytest.mark.parametrize("name", sorted(all_plans.QUERIES))
def test_query_matches_sql(spark, duck, tiny, name):
    rows, problem = compare(spark, duck, name, tiny)
    assert problem is None, problem
    assert rows >= 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 2


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
