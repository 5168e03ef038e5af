"""Every registered query of the subpackage: against its SQL where there is one, and that it runs on the whole smallest tables."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from ratestrata.llm.catalog import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    count, problems = differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name])
    assert not problems and count > 0


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_query_returns_a_row_per_row(spark, name):
    rows = QUERIES[name](spark, SF).count()
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    if name == "op5_neighbours":
        queries = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert rows == 20 * queries
    elif name == "op6_packing":
        assert rows >= documents
    else:
        assert rows == documents
