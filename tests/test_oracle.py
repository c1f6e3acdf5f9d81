"""Every registered query of the mart against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

from blotter.plans.queries import queries
from oracle_sql import oracle_sql

QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_small)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["crime_code", "crime_description", "month", "month_number", "crime_count",
                          "total_by_crime", "month_percentage"]
    assert df.count() > 0
