"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "subscriber_id"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, con):
    verdict = compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0
