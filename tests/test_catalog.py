"""Every registered query against its SQL, on the whole smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from ratestrata.catalog import QUERIES
from ratestrata.oracles import ORACLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["base_currency", "target_currency", "latest_rate"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, db, name):
    count, problems = differences(contract.queries()[name](spark, SF), db, contract.oracle_sql()[name])
    assert not problems
    assert count > 0
