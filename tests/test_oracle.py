"""Every named query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as E
from compare import compare, connect
from loadbay.catalog.oracle import ORACLE
from loadbay.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries()) & set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_entry_returns_rows(spark):
    assert E.entry(spark).count() > 0
