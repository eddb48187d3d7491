"""Named queries on rows made here."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starmart.plans import inputs
from starmart.plans.catalog import QUERIES


@pytest.fixture
def folder(spark, tmp_path):
    """Forty orders from December 1997 on, ten days apart, with two lines each."""
    first = datetime(1997, 12, 1)
    orders = [(i, i % 3, "F", 10.0 * i, first + timedelta(days=10 * i)) for i in range(40)]
    lines = [(i, (i + n) % 7 + 1, 1, n, float(n), 5.0 * i, o[4]) for i, o in enumerate(orders) for n in (1, 2)]
    parts = [(i, f"part {i}", "b", "t", 1.5 * i) for i in range(1, 9)]
    for name, rows in (("orders", orders), ("lineitem", lines), ("part", parts)):
        spark.createDataFrame(rows, inputs.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_quarter_of_the_fact_by_month(spark, folder):
    rows = QUERIES["fact_partition_pruned"](spark, folder).collect()
    days = [date(1997, 12, 1) + timedelta(days=10 * i) for i in range(40)]
    assert sorted(r.order_date_day for r in rows) == [d for d in days if date(1998, 1, 1) <= d < date(1998, 4, 1)]
    assert {(r.lines, r.units) for r in rows} == {(2, 3)}
