"""Every named query against its SQL counterpart on the smallest data set."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
# The training-data queries are compared in tests/llm, and may be absent.
OWN = set(contract.catalog.QUERIES)


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_sql():
    assert set(contract.oracle_sql()) >= OWN
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, oracle, name):
    assert differences(contract.queries()[name](spark, SF), oracle, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
