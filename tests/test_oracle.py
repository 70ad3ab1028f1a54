"""Every registered query gives what its SQL gives."""

import os

import pytest

import __spark_entry__ as contract
import oracle
from rangeload.catalog import ORACLES, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(oracle.DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert oracle.compare(spark, db, oracle.DATA, name, QUERIES[name], ORACLES[name]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
