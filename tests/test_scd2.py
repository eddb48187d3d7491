from datetime import datetime
from decimal import Decimal

import pytest

from starmart.operators import staging
from starmart.operators.scd2 import (
    first_snapshot,
    from_native_history,
    join_valid_at,
    snapshot,
)
from starmart.plans.dimensions import current_products, dim_products
from tests.conftest import as_rows, raw_products

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
FIRST = [
    (1, "same", "c", "d", "1.00", "USD"),
    (2, "dearer", "c", "d", "2.00", "USD"),
    (3, "gone", "c", "d", "3.00", "USD"),
    (4, "reworded", "c", "d", "4.00", "USD"),
    (5, "no currency", "c", None, "5.00", None),
]
SECOND = [
    FIRST[0],
    (2, "dearer", "c", "d", "2.50", "USD"),
    (4, "reworded", "c", "other words", "4.00", "USD"),
    (5, "no currency", "c", None, "5.00", "USD"),  # NULL to a value is a change
    (6, "new", "c", "d", "6.00", "USD"),
]


def extract(spark, rows):
    return staging.stg_products(raw_products(spark, rows))


def test_versions(spark):
    history = snapshot(first_snapshot(extract(spark, FIRST), T1), extract(spark, SECOND), T2)
    assert as_rows(history, "product_id", "base_price", "currency", "valid_from", "valid_to") == (
        sorted(
            [
                (1, Decimal("1.00"), "USD", T1, None),
                (2, Decimal("2.00"), "USD", T1, T2),
                (2, Decimal("2.50"), "USD", T2, None),
                (3, Decimal("3.00"), "USD", T1, None),
                (4, Decimal("4.00"), "USD", T1, None),
                (5, Decimal("5.00"), None, T1, T2),
                (5, Decimal("5.00"), "USD", T2, None),
                (6, Decimal("6.00"), "USD", T2, None),
            ],
            key=lambda r: [(v is not None, str(v)) for v in r],
        )
    )
    kept = history.filter("product_id = 4").first()
    assert kept.description == "d"


def test_same_extract_again_changes_nothing(spark):
    once = snapshot(first_snapshot(extract(spark, FIRST), T1), extract(spark, SECOND), T2)
    again = snapshot(once, extract(spark, SECOND), T3)
    assert as_rows(again) == as_rows(once)


def test_versions_never_overlap_and_one_is_current(spark):
    history = first_snapshot(extract(spark, FIRST), T1)
    for run_at, rows in ((T2, SECOND), (T3, FIRST)):
        history = snapshot(history, extract(spark, rows), run_at)
    versions = as_rows(history, "product_id", "valid_from", "valid_to")
    for product in range(1, 7):
        own = sorted((v for v in versions if v[0] == product), key=lambda v: v[1])
        assert [v[2] for v in own] == [*[v[1] for v in own[1:]], None]


def test_dimension_has_the_placeholder_and_one_row_per_current_product(spark):
    history = snapshot(first_snapshot(extract(spark, FIRST), T1), extract(spark, SECOND), T2)
    dimension = dim_products(history)
    assert dimension.filter("product_id = -1").first().product_name == "Unknown / Unmatched Product"
    ids = [r.product_id for r in current_products(dimension).collect()]
    assert sorted(ids) == [-1, 1, 2, 3, 4, 5, 6]


def test_native_history_opens_the_last_version(spark):
    rows = [(1, T1, T2), (1, T2, datetime(9999, 12, 31))]
    native = spark.createDataFrame(
        rows, "product_id long, valid_from timestamp_ntz, valid_to timestamp_ntz"
    )
    opened = from_native_history(native, datetime(9999, 12, 31))
    assert as_rows(opened) == sorted([(1, T1, T2), (1, T2, None)], key=lambda r: r[1])


@pytest.mark.parametrize("grain", ["month", "day"])
def test_valid_at_same_as_search(spark, grain, force_shuffle):
    """A hot product with many versions; lines on the boundaries, before and after."""
    versions = [
        (1, d, datetime(2024, 1, d), datetime(2024, 1, d + 1) if d < 28 else datetime(2024, 5, 1))
        for d in range(1, 29)
    ] + [(2, 99, datetime(2024, 1, 15), None)]
    lines = [
        (i, p, datetime(2024, m, d, h))
        for i, (p, m, d, h) in enumerate(
            (p, m, d, h)
            for p in (1, 2, 3)
            for m in (1, 2, 5)
            for d in (1, 15, 28)
            for h in (0, 12)
        )
    ]
    left = spark.createDataFrame(lines, "id long, product_id long, at timestamp_ntz")
    right = spark.createDataFrame(
        versions, "product_id long, price int, valid_from timestamp_ntz, valid_to timestamp_ntz"
    )
    out = join_valid_at(left, right, "product_id", "at", {"p": "price"}, ["id"], grain)

    def expected(product, at):
        return next(
            (v[1] for v in versions if v[0] == product and v[2] <= at and (not v[3] or at < v[3])),
            None,
        )

    assert {r.id: r.p for r in out.collect()} == {i: expected(p, at) for i, p, at in lines}
    assert out.count() == len(lines)
