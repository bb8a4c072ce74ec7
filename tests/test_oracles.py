"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from checks.entries import all_queries
from checks.oracles import all_oracles
from checks.compare import connect, duck_rows, spark_rows, type_differences
from tests.conftest import SF

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert spark_rows(df) == duck_rows(duck, ORACLES[name])
    assert not type_differences(df, duck, ORACLES[name])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
