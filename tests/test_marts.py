from datetime import date, datetime
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from starmart import schemas
from starmart.fixed_values import UNKNOWN_PRODUCT_ID
from starmart.operators import staging, upsert
from starmart.operators.quality import (
    DataTest,
    exception_rate_by_day,
    exceptions,
    raise_on_failure,
    reconcile,
    run_tests,
)
from starmart.operators.scd2 import first_snapshot, snapshot
from starmart.plans import dimensions, reports
from starmart.plans.fact import fact_order_items, order_items_usd
from starmart.schemas import FACT_COLUMNS
from starmart.sources import landing
from tests.conftest import BATCH_1, as_rows, raw_items, raw_orders, raw_products, raw_rates

NOON = datetime(2024, 7, 1, 12, 30)
RATES = [
    ("USD", "USD", "2024-06-01", "1"),
    (" eur", "usd ", "2024-06-01", "1.077"),
    ("EUR", "USD", "2024-09-15", "1.1059"),
    ("USD", "EUR", "2024-06-01", "0.9285"),
]
ORDERS = [
    (1, 100, NOON),
    (2, 100, datetime(2024, 10, 1, 23, 59)),
    (3, 101, NOON),
    (4, 101, datetime(2024, 7, 7, 0, 0)),  # a Sunday, no lines
]
PRODUCTS = [(1, " hub ", "E", None, "9.00", "usd"), (2, "treats", "P", None, "1.00", "USD")]
ITEMS = [
    (1, 1, 1, 2, "10.00", "USD"),
    (2, 1, 2, 1, "3.50", " eur "),  # padded, lower case
    (3, 2, 2, 3, "3.50", "EUR"),
    (4, 3, 77, 4, "1.00", "XYZ"),  # orphan product and unknown currency
    (5, 3, 2, 5, "1.00", None),  # no currency
    (6, 3, 1, 6, "1.00", "GBP"),  # known currency without a rate
    (7, 99, 1, 7, "1.00", "USD"),  # its order is missing
    (8, 3, 77, 1, "2.00", "USD"),  # orphan product only
]


@pytest.fixture
def star(spark):
    items = staging.stg_order_items(raw_items(spark, ITEMS))
    orders = staging.stg_orders(raw_orders(spark, ORDERS))
    rates = staging.stg_fx_rates(raw_rates(spark, RATES))
    staged = staging.stg_products(raw_products(spark, PRODUCTS))
    dearer = staging.stg_products(raw_products(spark, [(*PRODUCTS[0][:4], "9.50", "USD")]))
    history = snapshot(first_snapshot(staged, datetime(2024, 1, 1)), dearer, NOON)
    return items, orders, rates, dimensions.dim_products(history)


def test_staging_flags(star):
    flags = dict(as_rows(star[0], "order_item_id", "is_valid_currency"))
    assert flags == {1: True, 2: True, 3: True, 4: False, 5: None, 6: True, 7: True, 8: True}


def test_rates_keep_the_reporting_currency_only(star):
    assert as_rows(star[2], "currency") == [("EUR",), ("EUR",), ("USD",)]


def test_lines_in_usd_keep_lines_without_an_order(star):
    items, orders, rates, _ = star
    usd = {r.order_item_id: r for r in order_items_usd(items, orders, rates).collect()}
    assert usd[2].line_amount_usd == Decimal("3.76950000")
    assert usd[3].line_amount_usd == Decimal("11.61195000")
    assert usd[7].order_date is None and usd[7].rate_to_usd is None
    assert [k for k in sorted(usd) if usd[k].is_fx_convertible] == [1, 2, 3, 8]
    assert order_items_usd(items, orders, rates, "inner").count() == len(ITEMS) - 1


def check_fact(star):
    fact = fact_order_items(*star)
    assert tuple(fact.columns) == FACT_COLUMNS
    rows = {r.order_item_id: r for r in fact.collect()}
    # two versions of product 1 do not repeat its lines; line 7 has no order
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 8] and fact.count() == 7
    assert (rows[4].product_id, rows[4].is_unknown_product) == (-1, True)
    assert (rows[3].order_date_day, rows[3].order_hour) == (date(2024, 10, 1), 23)
    assert rows[1].customer_id == 100


def test_fact(star):
    check_fact(star)


def test_fact_without_broadcast(star, force_shuffle):
    check_fact(star)


def test_exceptions(star):
    rows = {r.order_item_id: r for r in exceptions(fact_order_items(*star)).collect()}
    assert sorted(rows) == [4, 5, 6, 8]
    assert rows[4].exception_reasons == "invalid_currency_code; product_id_not_in_catalogue"
    assert rows[8].exception_reasons == "product_id_not_in_catalogue"
    # a failed conversion is a flag, not a reason; a missing code gives no flag
    assert rows[6].exception_reasons == "" and rows[6].flag_fx_conversion_failed
    assert rows[5].flag_invalid_currency_code is None


def test_top_products(star):
    fact = fact_order_items(*star)
    found = as_rows(
        reports.top_products(fact, star[3]),
        "product_id",
        "product_name",
        "units_sold",
        "revenue_usd",
        "order_count",
        "rank_by_volume",
        "rank_by_revenue",
    )
    assert found == [
        (1, "hub", 8, Decimal("20.00000000"), 2, 2, 1),
        (2, "treats", 9, Decimal("15.38145000"), 3, 1, 2),
    ]
    (best,) = reports.best_sellers(reports.top_products(fact, star[3]), 1).collect()
    assert best.product_id == 1


def test_product_without_a_convertible_line_is_ranked_last(star):
    fact = fact_order_items(*star).filter("order_item_id in (3, 6)")
    found = as_rows(
        reports.top_products(fact, star[3]), "product_id", "revenue_usd", "rank_by_revenue"
    )
    assert found == [(1, None, 2), (2, Decimal("11.61195000"), 1)]


def test_hours(spark, star):
    fact = fact_order_items(*star)
    hours = dimensions.dim_time_of_day(spark)
    rows = {r.hour_of_day: r for r in reports.promo_time_of_day(fact, hours).collect()}
    assert sorted(rows) == list(range(24))
    # order 1 and order 3 at noon; order 3 converts only its last line
    assert rows[12].order_count == 2 and rows[12].revenue_usd == Decimal("25.76950000")
    assert round(rows[12].avg_order_value_usd, 4) == Decimal("12.8848")
    assert rows[12].rank_by_order_count == 1 and rows[23].rank_by_order_count == 2
    assert rows[5].order_count == 0 and rows[5].revenue_usd is None
    assert rows[5].rank_by_order_count == 3
    by_line = {r.hour_of_day: r for r in reports.promo_by_line(fact, hours).collect()}
    assert all(by_line[h].order_count == rows[h].order_count for h in rows)
    assert all(by_line[h].revenue_usd == rows[h].revenue_usd for h in rows)


def test_kpis_and_reconciliation(star):
    fact = fact_order_items(*star)
    kpi = reports.kpis(fact).first()
    assert kpi.total_revenue_usd == Decimal("37.38")
    assert (kpi.total_units, kpi.total_orders, kpi.dq_exceptions, kpi.total_lines) == (22, 3, 4, 7)
    totals = reconcile(fact, reports.top_products(fact, star[3])).first()
    assert totals.is_reconciled and totals.unknown_units == 5
    short = reports.top_products(fact, star[3]).filter("product_id = 1")
    assert not reconcile(fact, short).first().is_reconciled


def test_kpis_of_an_empty_fact(star):
    kpi = reports.kpis(fact_order_items(*star).filter("false")).first()
    assert kpi.total_lines == 0 and kpi.flagged_line_rate is None


def test_calendar(spark):
    days = {r.date_day: r for r in dimensions.dim_date(spark).collect()}
    assert len(days) == 366
    sunday = days[date(2024, 7, 7)]
    assert (sunday.day_of_week_num, sunday.day_of_week_name, sunday.is_weekend) == (0, "Sunday", True)
    monday = days[date(2024, 7, 8)]
    assert (monday.day_of_week_num, monday.is_weekend, monday.quarter) == (1, False, 3)
    assert days[date(2024, 12, 31)].month_name == "December"


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        items = staging.stg_order_items(raw_items(spark, ITEMS))
        mark = upsert.high_water_mark(items).first()[0]
        assert mark == BATCH_1
        assert upsert.newer_than(items, mark).count() == 0
        assert upsert.high_water_mark(items.filter("false")).first()[0] == datetime(1900, 1, 1)
        staged = staging.stg_products(raw_products(spark, PRODUCTS))
        assert first_snapshot(staged, NOON).first().valid_from == NOON
        stamped = landing.stamp_loaded_at(raw_orders(spark, ORDERS).drop("_loaded_at"), "id", 9)
        assert stamped.first()._loaded_at == BATCH_1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_parts(spark):
    rows = as_rows(dimensions.dim_time_of_day(spark), "hour_of_day", "day_part", "day_part_sort")
    by_hour = {h: (p, s) for h, p, s in rows}
    assert by_hour[5] == ("Night (00-05)", 1) and by_hour[6] == ("Morning (06-11)", 2)
    assert by_hour[17] == ("Afternoon (12-17)", 3) and by_hour[18] == ("Evening (18-23)", 4)


def test_data_tests_and_gate(spark):
    child = spark.createDataFrame(
        [(1, 1, True), (1, 2, False), (2, 9, None), (None, 9, False), (None, None, True)],
        "id long, parent_id long, ok boolean",
    )
    parent = spark.createDataFrame([(1,), (2,)], "parent_id long")
    tests = [
        DataTest("child", "id", "not_null"),
        DataTest("child", "id", "unique"),
        DataTest("child", "ok", "always_true", "warn"),
        DataTest("child", "parent_id", "relationship", parent="parent"),
        DataTest("parent", "parent_id", "unique"),
    ]
    results = run_tests({"child": child, "parent": parent}, tests)
    found = {(r.model, r.test): (r.failures, r.status) for r in results.collect()}
    assert found == {
        ("child", "not_null"): (2, "fail"),
        ("child", "unique"): (1, "fail"),
        ("child", "always_true"): (2, "warn"),
        ("child", "relationship"): (2, "fail"),
        ("parent", "unique"): (0, "pass"),
    }
    with pytest.raises(ValueError, match="child.id unique: 1"):
        raise_on_failure(results)
    raise_on_failure(results.filter("test = 'always_true'"))


def test_exception_rate_stands_out(spark):
    # one or two bad lines of twelve on all days but one
    rows = [
        (date(2024, 1, d), d == 28 or i <= d % 2) for d in range(1, 30) for i in range(12)
    ]
    fact = spark.createDataFrame(rows, "order_date_day date, bad boolean").selectExpr(
        "order_date_day", "true as is_valid_currency", "bad as is_unknown_product",
        "true as is_fx_convertible",
    )
    unusual = exception_rate_by_day(fact).filter("is_unusual").collect()
    assert [r.order_date_day for r in unusual] == [date(2024, 1, 28)]
    assert unusual[0].is_over_limit


def test_lines_of_products_are_not_added_up_before_the_shuffle(spark):
    """(product, order) hardly repeats, so a task would hold every line of its input."""
    rows = [(1, 1, 2), (1, 1, 3), (1, 2, 1), (2, None, 4), (UNKNOWN_PRODUCT_ID, 3, 9)]
    lines = spark.createDataFrame(rows, "product_id long, order_id long, quantity int")
    lines = lines.withColumns(
        {"line_amount_usd": F.lit(1).cast(schemas.AMOUNT), "is_fx_convertible": F.col("product_id") == 1}
    )
    totals = reports.product_totals(lines)
    assert as_rows(totals) == [(1, 6, Decimal(3), 2), (2, 4, None, 0)]
    text = totals._jdf.queryExecution().executedPlan().toString()
    below = text[text.rindex("Exchange hashpartitioning(product_id"):]
    assert "order_id" in below.splitlines()[0] and "Aggregate" not in below
