"""Every registered query against its SQL on the smallest tables; models by invariants."""

from __future__ import annotations

import pytest
from oracle import database, differences

import __spark_entry__ as contract
from tagloom.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_contract(spark):
    assert contract.queries().keys() >= contract.oracle_sql().keys()
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], FOLDER) == []


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
