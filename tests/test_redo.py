import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from starmart import published
from starmart.operators import redo, staging
from starmart.operators.scd2 import first_snapshot
from starmart.operators.upsert import upsert_partitions
from starmart.plans.dimensions import dim_products
from starmart.plans.fact import fact_order_items
from tests.conftest import BATCH_1, as_rows, raw_items, raw_orders, raw_products, raw_rates

DAY = date(2024, 1, 1)


def days(n):
    return DAY + timedelta(days=n)


def nearest(history, key, day):
    """The last rate on or before a day, else the first later one; of equal days the smallest."""
    mine = sorted((d, v) for k, d, v in history if k == key)
    past = [d for d, _ in mine if d <= day]
    at = max(past) if past else min((d for d, _ in mine), default=None)
    return min((v for d, v in mine if d == at), default=None)


@pytest.mark.parametrize("seed", range(4))
def test_intervals_hold_exactly_the_days_that_change(spark, seed):
    rng = random.Random(seed)
    keys = ["A", "B", "C", "D"]
    before = [(rng.choice(keys[:3]), days(rng.randrange(5, 25)), Decimal(rng.randrange(1, 4))) for _ in range(12)]
    after = rng.sample(before, 9) + [(rng.choice(keys), days(rng.randrange(5, 25)), Decimal(rng.randrange(1, 4))) for _ in range(4)]
    tables = [spark.createDataFrame(rows, "key string, day date, v decimal(18,6)") for rows in (before, after)]
    changed = redo.changed_intervals(*tables, "key", "day", "v")
    calendar = redo.changed_calendar(changed, "key", "v", days(0), days(30))
    found = {(r.key, r["_day"]): r["_new"] for r in calendar.collect()}
    wanted = {}
    for key in keys:
        for n in range(31):
            was, now = nearest(before, key, days(n)), nearest(after, key, days(n))
            if was != now:
                wanted[key, days(n)] = now
    assert found == wanted and calendar.count() == len(wanted)


@pytest.fixture(scope="module")
def shop(spark):
    orders = staging.stg_orders(raw_orders(spark, [(i, 1, datetime(2024, 1, i, 9)) for i in range(1, 21)]))
    rows = [(i, i % 20 + 1, i % 4 + 1, 2, "10.00", ["USD", "EUR", "GBP", "XYZ"][i % 3 if i % 7 else 3]) for i in range(1, 81)]
    items = staging.stg_order_items(raw_items(spark, rows))
    known = [(p, f"p{p}", "c", None, "1.00", "USD") for p in (1, 2, 3)]
    products = dim_products(first_snapshot(staging.stg_products(raw_products(spark, known)), BATCH_1))
    return items, orders, products


EARLY = [("USD", "USD", "2024-01-01", "1"), ("EUR", "USD", "2024-01-01", "1.1"), ("EUR", "USD", "2024-01-15", "1.2")]
LATE = [*EARLY, ("EUR", "USD", "2024-01-08", "1.15"), ("GBP", "USD", "2024-01-18", "1.3")]


def rates(spark, rows):
    return staging.stg_fx_rates(raw_rates(spark, rows))


@pytest.mark.parametrize("broadcast", [True, False])
def test_late_rates_change_their_lines_only(spark, tmp_path, shop, broadcast, request):
    if not broadcast:
        request.getfixturevalue("force_shuffle")
    items, orders, products = shop
    path = str(tmp_path / "fact")
    first = fact_order_items(items, orders, rates(spark, EARLY), products)
    before = upsert_partitions(path, first)
    delta = redo.lines_to_rerate(path, first.schema, rates(spark, EARLY), rates(spark, LATE))
    rebuilt = as_rows(fact_order_items(items, orders, rates(spark, LATE), products))
    was = as_rows(first)
    assert as_rows(delta) == [r for r in rebuilt if r not in was] and delta.count() > 10
    if broadcast:
        after = upsert_partitions(path, delta)
        assert as_rows(published.read(spark, path, first.schema)) == rebuilt
        # EUR: 8th to 14th; GBP: all days, as the only rate counts for the past too
        touched = {n[-10:] for n, load in after.folders.items() if before.folders[n] != load}
        assert touched == {str(d) for d in {r.order_date_day for r in delta.collect()}}
        again = redo.lines_to_rerate(path, first.schema, rates(spark, LATE), rates(spark, LATE))
        assert again is None or again.count() == 0


def test_only_changed_days_are_opened(spark, tmp_path, shop):
    items, orders, products = shop
    path = str(tmp_path / "fact")
    first = fact_order_items(items, orders, rates(spark, EARLY), products)
    upsert_partitions(path, first)
    late = [*EARLY, ("EUR", "USD", "2024-01-08", "1.15")]
    delta = redo.lines_to_rerate(path, first.schema, rates(spark, EARLY), rates(spark, late))
    opened = {f.split("order_date_day=")[1][:10] for f in delta.inputFiles() if "order_date_day=" in f}
    assert opened == {str(date(2024, 1, d)) for d in range(8, 15)}


def test_a_withdrawn_rate(spark, tmp_path, shop):
    items, orders, products = shop
    path = str(tmp_path / "fact")
    first = fact_order_items(items, orders, rates(spark, LATE), products)
    upsert_partitions(path, first)
    less = [r for r in LATE if r[0] != "GBP"]
    upsert_partitions(path, redo.lines_to_rerate(path, first.schema, rates(spark, LATE), rates(spark, less)))
    rebuilt = fact_order_items(items, orders, rates(spark, less), products)
    assert as_rows(published.read(spark, path, first.schema)) == as_rows(rebuilt)


def test_late_products(spark, shop):
    items, orders, products = shop
    more = dim_products(
        first_snapshot(staging.stg_products(raw_products(spark, [(p, "x", "c", None, "1.00", "USD") for p in (2, 3, 4)])), BATCH_1)
    )
    found = redo.lines_of_new_products(items, products, more)
    assert {r.product_id for r in found.collect()} == {1, 4}  # one has left, one has come
    assert found.count() == items.filter("product_id in (1, 4)").count()
