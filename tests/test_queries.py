"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as contract
from skylattice import oracle, registry
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(registry.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert_same(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name])


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.columns == ["date", "hour", "year", "month", "day", "active_aircraft_count"]
    assert result.count() > 0
