"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck_connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duck_connection(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    if name in oracle_sql():
        assert compare(spark, connection, name, SF, queries(), oracle_sql()) == ""
    else:
        assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
