"""The whole build on published extracts, against the published results.

Set GOLDEN_EXTRACTS to the folder with the raw CSV extracts; without it this is skipped.
"""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.quality import exceptions
from starmart.plans import reports
from starmart.plans.warehouse import Warehouse, build, export_reports, write_raw_orders
from starmart.sources.readers import read_raw

EXTRACTS = os.environ.get("GOLDEN_EXTRACTS")

pytestmark = pytest.mark.skipif(not EXTRACTS, reason="GOLDEN_EXTRACTS is not set")

RUN_1, RUN_2, RUN_3 = (datetime(2025, 1, d, 3) for d in (1, 2, 3))


def raw(spark, suffix=""):
    extracts = {"raw_orders": f"raw_orders{suffix}", "raw_order_items": f"raw_order_items{suffix}"}
    names = ("raw_customers", "raw_orders", "raw_order_items", "raw_products", "raw_fx_rates")
    return {n: read_raw(spark, EXTRACTS, n, extracts.get(n)) for n in names}


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    build(wh, raw(spark, "_batch1"), RUN_1)
    assert wh.fact().count() == 303
    results = build(wh, raw(spark), RUN_2)
    assert wh.fact().count() == 363
    statuses = [r.status for r in results.collect()]
    assert sorted(statuses) == ["pass"] * 31 + ["warn"] * 3
    return wh


def test_rerun_changes_nothing(spark, warehouse):
    before = sorted(map(tuple, warehouse.fact().collect()), key=str)
    build(warehouse, raw(spark), RUN_3)
    # a repeated load from the first mark gives the same table too
    build(warehouse, raw(spark), RUN_3, since=datetime(2025, 1, 1, 2))
    assert sorted(map(tuple, warehouse.fact().collect()), key=str) == before
    assert warehouse.mart("dim_products").count() == 101


def test_full_load_equals_incremental(spark, warehouse, tmp_path):
    full = Warehouse(spark, str(tmp_path))
    build(full, raw(spark), RUN_1)
    assert sorted(map(tuple, full.fact().collect()), key=str) == sorted(
        map(tuple, warehouse.fact().collect()), key=str
    )


def test_kpis(warehouse):
    kpi = reports.kpis(warehouse.fact()).first()
    # Published headline numbers.
    assert kpi.total_revenue_usd == Decimal("81325.83")
    assert (kpi.total_units, kpi.total_orders) == (988, 360)
    assert (kpi.dq_exceptions, kpi.total_lines) == (78, 363)


def test_conversion(warehouse):
    fact = warehouse.fact()
    assert fact.filter("is_fx_convertible").count() == 288


def test_exceptions(warehouse):
    by_reason = {
        r.exception_reasons: r["count"]
        for r in exceptions(warehouse.fact()).groupBy("exception_reasons").count().collect()
    }
    assert by_reason == {
        "invalid_currency_code; product_id_not_in_catalogue": 68,
        "invalid_currency_code": 7,
        "product_id_not_in_catalogue": 3,
    }


def test_top_products(warehouse):
    report = reports.top_products(warehouse.fact(), warehouse.mart("dim_products"))
    rows = report.collect()
    best = next(r for r in rows if r.rank_by_revenue == 1)
    assert (best.product_id, best.units_sold, best.rank_by_volume) == (9, 4, 56)
    assert round(best.revenue_usd, 2) == Decimal("1693.60")
    most = next(r for r in rows if r.rank_by_volume == 1)
    assert (most.product_id, most.units_sold) == (87, 40)
    assert len(rows) == 98 and sum(r.units_sold for r in rows) == 814
    total = sum(r.revenue_usd for r in rows if r.revenue_usd is not None)
    assert round(total, 6) == Decimal("80350.963202")


def test_hours(warehouse):
    report = reports.promo_time_of_day(warehouse.fact(), warehouse.mart("dim_time_of_day"))
    rows = {r.hour_of_day: r for r in report.collect()}
    assert (rows[14].order_count, round(rows[14].revenue_usd, 6)) == (52, Decimal("10807.006054"))
    assert (rows[15].order_count, round(rows[15].revenue_usd, 6)) == (49, Decimal("11463.479462"))
    assert round(rows[15].avg_order_value_usd, 2) == Decimal("293.94")
    assert round(rows[14].avg_order_value_usd, 2) == Decimal("251.33")
    assert sum(r.order_count == 0 and r.revenue_usd is None for r in rows.values()) == 14


def test_exported_files(spark, warehouse, tmp_path):
    export_reports(warehouse, str(tmp_path))
    sizes = {
        folder.name: spark.read.option("header", True).csv(str(folder)).count()
        for folder in tmp_path.iterdir()
    }
    assert sizes == {
        "rpt_top_products": 98,
        "rpt_promo_time_of_day": 24,
        "rpt_data_quality_exceptions": 78,
        "kpis_summary": 1,
    }


def test_raw_layer_by_day(spark, warehouse):
    write_raw_orders(warehouse, raw(spark)["raw_orders"])
    written = spark.read.parquet(warehouse.path("raw", "orders"))
    assert written.count() == 453
    assert written.filter(F.col("order_day") != F.col("order_date").cast("date")).count() == 0
