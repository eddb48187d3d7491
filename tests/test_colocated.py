import pytest
from pyspark.sql import functions as F

from starmart.operators.colocated import LINES, PARTS, Colocated
from tests.conftest import as_rows

LINE, ORDER = "id long, order_id long, v string", "order_id long, customer_id long"


def lines(spark, first, last, hot=7):
    """A third of the lines belong to one order, some to none."""
    order = F.when(F.col("id") % 3 == 0, hot).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    return spark.range(first, last).select("id", order.cast("long").alias("order_id"), F.lit("x").alias("v"))


def orders(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("order_id"), (F.col("id") * 10).alias("customer_id"))


@pytest.fixture
def pair(spark, tmp_path):
    pair = opened(spark, tmp_path)
    yield pair
    pair.close()


def opened(spark, folder):
    schemas = [spark.createDataFrame([], t).schema for t in (LINE, ORDER)]
    return Colocated(spark, str(folder / "pair"), *schemas, "order_id", ["id"], buckets=16)


def assert_joins(pair, all_lines, all_orders):
    for how in ("inner", "left"):
        plain = all_lines.join(all_orders, "order_id", how).select("id", "order_id", "v", "customer_id")
        assert as_rows(pair.joined(how, ["customer_id"])) == as_rows(plain)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_without_an_exchange(spark, pair, force_shuffle):
    rows, placed = lines(spark, 0, 6000), orders(spark, 0, 380)
    pair.add(rows, placed, "1")
    assert "Exchange" in plan(rows.join(placed, "order_id"))
    for how in ("inner", "left"):
        found = plan(pair.joined(how, ["customer_id"]))
        assert "SortMergeJoin" in found and "Exchange" not in found
    assert_joins(pair, rows, placed)


def test_hot_order_is_spread(spark, pair):
    rows = lines(spark, 0, 6000)
    pair.add(rows, orders(spark, 0, 380), "1")
    owned = rows.filter("order_id = 7").count()
    by_bucket = spark.table(pair._names[LINES]).filter("order_id = 7").groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in by_bucket.collect()]
    assert sum(sizes) == owned and len(sizes) > 1 and max(sizes) < owned


def test_later_batches(spark, pair, force_shuffle):
    """Order 200 is there before it is hot; the last orders arrive after their lines."""
    batches = [(lines(spark, 0, 3000), orders(spark, 0, 300)), (lines(spark, 3000, 9000, 200), orders(spark, 300, 400))]
    for n, batch in enumerate(batches):
        pair.add(*batch, str(n))
    every = [a.union(b) for a, b in zip(*batches)]
    assert_joins(pair, *every)
    assert "Exchange" not in plan(pair.joined("inner", ["customer_id"]))


def test_a_broken_batch_is_repeated(spark, pair, monkeypatch):
    first, second = (lines(spark, 0, 3000), orders(spark, 0, 300)), (lines(spark, 3000, 6000, 200), orders(spark, 300, 400))
    pair.add(*first, "1")
    append = Colocated._append

    def broken(self, table, df, batch):
        append(self, table, df, batch)
        if table != LINES:
            raise RuntimeError("writer stopped")

    with monkeypatch.context() as patch:
        patch.setattr(Colocated, "_append", broken)
        with pytest.raises(RuntimeError):
            pair.add(*second, "2")
    for _ in range(2):
        pair.add(*second, "2")
        assert_joins(pair, first[0].union(second[0]), first[1].union(second[1]))
    with pytest.raises(ValueError):
        pair.add(*first, "1")


def test_another_session_opens_the_files(spark, pair, tmp_path):
    rows, placed = lines(spark, 0, 1000), orders(spark, 0, 380)
    pair.add(rows, placed, "1")
    again = opened(spark, tmp_path)
    assert again.batches() == ["1"]
    assert_joins(again, rows, placed)
    again.close()
    assert pair.lines().count() == 1000


def test_empty_tables(spark, pair):
    pair.add(lines(spark, 0, 0), orders(spark, 0, 0), "1")
    assert pair.joined("left", ["customer_id"]).count() == 0
    assert spark.read.parquet(f"{pair.path}/{PARTS}/1").count() == 0
