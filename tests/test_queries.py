"""Every registered query on the smallest tables; those with SQL must equal DuckDB."""

import pytest

import __spark_entry__ as contract
from tools.check_queries import compare, duck, types

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    relation = con.execute(contract.oracle_sql()[name])
    assert types(df, relation) == ""
    assert compare(df, relation) == ""


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_runs(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0
    spark.catalog.clearCache()


def test_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 50 and rows[0]["n"] >= rows[-1]["n"]
