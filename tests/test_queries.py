"""Every registered query beside its SQL, on the small tables."""

import pytest
from check_queries import compare, duck

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert driver.QUERIES.keys() == driver.ORACLES.keys()


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", driver.QUERIES)
def test_query_equals_sql(spark, con, name):
    got, want = compare(spark, con, name, SF_DIR)
    assert got == want
