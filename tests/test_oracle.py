"""Every registered query against its SQL; NOVALAKE_SF_DIR picks the data."""

from __future__ import annotations

import os

import pytest
from compare import difference, duck

import __spark_entry__ as driver
from novalake.queries import all_oracles, all_queries

SF_DIR = os.environ.get("NOVALAKE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_entry_registers_them():
    assert QUERIES.items() <= driver.queries().items()
    assert SQL.items() <= driver.oracle_sql().items()


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
