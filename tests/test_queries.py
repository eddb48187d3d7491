"""Every named query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from starmart.plans.catalog import QUERIES
from starmart.plans.oracle import ORACLE_SQL
from tests.sql_compare import connect, difference

FOLDER = os.environ.get("STARMART_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(con, oracle_sql()[name], queries()[name](spark, FOLDER)) is None


@pytest.mark.parametrize(
    "name",
    ["fact_order_items", "rpt_top_products", "pit_product_join", "fact_incremental", "dq_tests"],
)
def test_query_equals_sql_without_broadcast(spark, con, name, force_shuffle):
    assert difference(con, oracle_sql()[name], queries()[name](spark, FOLDER)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns[0] == "product_id"
