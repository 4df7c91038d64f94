"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from scripts.check_oracle import compare, duckdb_views

SQL = E._library_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(E._library_queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(E._library_queries()))
def test_query_matches_oracle(spark, con, name):
    got = E._library_queries()[name](spark, SF_SMALL).toPandas()
    assert compare(got, con.execute(SQL[name]).df()) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "BTCH_CR_TS" not in df.columns
