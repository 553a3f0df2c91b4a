"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from strataload.registry.oracles import ORACLES
from strataload.registry.queries import QUERIES

DIRECTORY = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIRECTORY), reason="tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(DIRECTORY)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.queries()) >= set(contract.oracle_sql()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    df = contract.queries()[name](spark, DIRECTORY)
    assert differences(df, connection, contract.oracle_sql()[name]) is None


def test_flagship_query(spark):
    assert contract.entry(spark).count() > 0
