"""Every registered query on the smallest driver tables against its SQL."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from tallystream.plans import registry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

registry.load_all()
QUERIES, SQL = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert oracle.difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
