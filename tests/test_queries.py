"""Every registered query against its SQL on the given tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from starmart.driver.oracle import ORACLE
from starmart.driver.queries import QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    frame = entry_module.queries()[name](spark, sf_dir)
    assert differences(frame, tables, entry_module.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
