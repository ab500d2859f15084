"""The driver contract, and every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from starmart.bindings.catalog import QUERIES
from starmart.bindings.oracle import ORACLE
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql_and_the_other_way_round():
    assert QUERIES and set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_fact_table(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["customer_key", "product_key", "seller_key", "date_key"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, FOLDER, name) == []
