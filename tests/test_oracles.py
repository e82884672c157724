"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ["training_set", "feature_lookup", "score_lookup", "balanced_sample", "exact_split"])
def test_query_without_broadcast(spark, con, no_broadcast, name):
    assert compare(contract.queries()[name](spark, FOLDER), con, SQL[name]) == ""


def test_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["split", "target", "n_rows", "n_found", "mean_z"]
    assert df.count() > 0
