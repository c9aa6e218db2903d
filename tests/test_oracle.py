"""Every registered query against its SQL, as row multisets with types."""

import pytest

import __spark_entry__ as registry
from gridcast.plans.oracle import ORACLE as ORACLES
from gridcast.plans.queries import QUERIES
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), ORACLES[name], con) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registry.queries().keys() and ORACLES.keys() <= registry.oracle_sql().keys()


def test_entry_is_the_city_forecast(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "unique_key" and df.count() > 0
