"""Plans, as the optimizer leaves them."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from starmart.operators.quality import is_exception
from starmart import published
from starmart.operators.upsert import newer_than, upsert_partitions
from starmart.plans import catalog, reports
from tests.conftest import BATCH_1

FOLDER = os.environ.get("STARMART_TABLES", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def fact(spark):
    return catalog._landed_fact(spark, FOLDER)


@pytest.mark.parametrize(
    "name", ["fact_order_items", "fx_asof_interval", "fx_asof_ranked", "pit_product_join"]
)
def test_no_pairwise_joins(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_small_sides_are_broadcast_and_lines_not_shuffled(spark):
    text = plan(catalog._fact(spark, FOLDER))
    assert text.count("+- BroadcastExchange") == 3 and "SortMergeJoin" not in text


def test_kpis_read_only_their_columns(fact):
    (columns,) = re.findall(r"ReadSchema: struct<(.*)>", plan(reports.kpis(fact)))
    read = {c.split(":")[0] for c in re.findall(r"\w+:[a-z]+", columns)}
    assert read == {
        "order_id", "quantity", "line_amount_usd", "is_fx_convertible",
        "is_valid_currency", "is_unknown_product",
    }


def test_load_mark_reaches_the_scan(fact):
    text = plan(newer_than(fact, BATCH_1))
    assert re.search(r"PushedFilters: .*GreaterThan\(_loaded_at,2025-01-01T02:00\)", text)


def test_exception_and_placeholder_filters_reach_the_scan(fact):
    assert "Not(EqualTo(product_id,-1))" in plan(reports.product_totals(fact))
    assert re.search(r"PushedFilters: .*is_unknown_product", plan(fact.filter(is_exception())))


def test_days_are_pruned_by_directory(spark, fact, tmp_path):
    path = str(tmp_path / "by_day")
    upsert_partitions(path, fact.filter(F.year("order_date_day") == 1998))
    week = F.col("order_date_day").between(F.lit("1998-01-05"), F.lit("1998-01-11"))
    text = plan(published.read(spark, path, fact.schema).filter(week))
    assert re.search(r"PartitionFilters: \[.*order_date_day.*1998-01-05", text)

