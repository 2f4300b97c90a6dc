"""Every registered query agrees with its SQL statement."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
