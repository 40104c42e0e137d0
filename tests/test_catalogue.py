"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, difference
from vinculo.catalogue import ENTRIES, Tables

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def oracle():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.mark.parametrize("name", [name for name, entry in ENTRIES.items() if entry.sql is not None])
def test_query_equals_sql(spark, oracle, tables, name):
    assert difference(spark, oracle, ENTRIES[name], tables) is None


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).limit(1).count() == 1
