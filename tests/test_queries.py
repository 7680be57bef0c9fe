"""Every catalog query against its SQL twin, and the driver contract."""

import pytest
from oracle_check import compare, database

import __spark_entry__ as entry
from tickmart.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return database(small)


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 397


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, small, con, name):
    df = entry.queries()[name](spark, small)
    _, difference = compare(df, con, entry.oracle_sql()[name])
    assert not difference
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert bad not in plan
