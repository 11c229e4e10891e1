"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from movrec.plans.catalog import PLANS
from conftest import SF001
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_matches_oracle(spark, con, name):
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    problems, n_spark, n_duck = compare(E.queries()[name](spark, SF001), con, sql)
    assert problems == [], problems
    assert n_spark == n_duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 51
