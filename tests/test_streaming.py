from datetime import datetime
from functools import partial

from pyspark.sql import functions as F

from starmart import published
from starmart.operators import staging
from starmart.operators.latest import latest_by_key
from starmart.operators.scd2 import first_snapshot
from starmart.operators.upsert import upsert_partitions
from starmart.plans.dimensions import dim_products
from starmart.plans.fact import fact_order_items
from starmart.plans.warehouse import FACT_SCHEMA
from starmart.streaming.change_stream import start_landing
from starmart.streaming.fact_stream import Waiting, start_fact_upserts
from starmart.streaming.latest_stream import start_latest
from tests.conftest import BATCH_1, BATCH_2, as_rows, raw_items, raw_orders, raw_products, raw_rates


def test_stream_equals_batch(spark, tmp_path):
    orders = staging.stg_orders(
        raw_orders(spark, [(i, 1, datetime(2024, 1, i, 9)) for i in range(1, 6)])
    )
    rates = staging.stg_fx_rates(raw_rates(spark, [("USD", "USD", "2024-01-01", "1")]))
    staged = staging.stg_products(raw_products(spark, [(1, "a", "c", None, "1.00", "USD")]))
    products = dim_products(first_snapshot(staged, BATCH_1))
    batches = [
        [(1, 1, 1, 1, "1.00", "USD"), (2, 2, 9, 1, "1.00", "USD")],
        # a correction twice in one batch, the newer first; a line late with an old stamp
        [
            (1, 1, 1, 5, "1.00", "USD", BATCH_2),
            (1, 1, 1, 4, "1.00", "USD", BATCH_1),
            (3, 3, 1, 1, "1.00", "XYZ", BATCH_1),
        ],
    ]
    landed, path, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    for rows in batches:
        batch = raw_items(spark, rows)
        batch.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(batch.schema).parquet(landed)
        start_fact_upserts(
            stream, orders, rates, products, partial(upsert_partitions, path), state
        ).awaitTermination()
    final = raw_items(spark, [batches[1][0], batches[0][1], batches[1][2]])
    expected = fact_order_items(staging.stg_order_items(final), orders, rates, products)
    assert as_rows(published.read(spark, path, expected.schema)) == as_rows(expected)


def test_late_rows_and_late_orders(spark, tmp_path):
    rates = staging.stg_fx_rates(raw_rates(spark, [("USD", "USD", "2024-01-01", "1")]))
    staged = staging.stg_products(raw_products(spark, [(1, "a", "c", None, "1.00", "USD")]))
    products = dim_products(first_snapshot(staged, BATCH_1))
    landed, path, state = (str(tmp_path / n) for n in ("raw", "fact", "state"))
    steps = [  # (lines, orders landed by then)
        ([(1, 1, 1, 5, "1.00", "USD", BATCH_2), (2, 2, 1, 1, "1.00", "USD", BATCH_2)], 1),
        # an older version of line 1 in a later batch; order 2 still missing
        ([(1, 1, 1, 4, "1.00", "USD", BATCH_1), (3, 3, 1, 1, "1.00", "USD", BATCH_2)], 1),
        ([(4, 1, 1, 1, "1.00", "USD", BATCH_2)], 3),
    ]
    for rows, known in steps:
        batch = raw_items(spark, rows)
        batch.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(batch.schema).parquet(landed)
        orders = staging.stg_orders(
            raw_orders(spark, [(i, 1, datetime(2024, 1, i, 9)) for i in range(1, known + 1)])
        )
        start_fact_upserts(
            stream, orders, rates, products, partial(upsert_partitions, path), state
        ).awaitTermination()
    lines = published.read(spark, path, FACT_SCHEMA).select("order_item_id", "quantity")
    assert as_rows(lines) == [(1, 5), (2, 1), (3, 1), (4, 1)]


def test_orders_that_land_without_lines_release_theirs(spark, tmp_path):
    """Lines wait in buckets of their order; a replayed batch sees what waited before it."""
    rates = staging.stg_fx_rates(raw_rates(spark, [("USD", "USD", "2024-01-01", "1")]))
    staged = staging.stg_products(raw_products(spark, [(1, "a", "c", None, "1.00", "USD")]))
    products = dim_products(first_snapshot(staged, BATCH_1))
    lines_at, orders_at, path, state = (str(tmp_path / n) for n in ("lines", "orders", "fact", "state"))
    order = lambda i: (i, 1, datetime(2024, 1, i, 9))
    steps = [  # (lines, orders) that land, and the lines in the fact afterwards
        ([(n, n, 1, 1, "1.00", "USD", BATCH_2) for n in range(1, 9)], [order(1)], {1: 1}),
        ([(3, 3, 1, 7, "1.00", "USD", BATCH_1)], [], {1: 1}),  # an old version joins the queue
        ([], [order(3), order(4)], {1: 1, 3: 1, 4: 1}),
        ([(4, 4, 1, 9, "1.00", "USD", BATCH_1)], [order(9)], {1: 1, 3: 1, 4: 1}),
        ([], [order(i) for i in (2, 5, 6, 7, 8)], {n: 1 for n in range(1, 9)}),
    ]
    known, waiting = [], Waiting(spark, f"{state}-waiting")
    for lines, orders, wanted in steps:
        items, landing = raw_items(spark, lines), raw_orders(spark, orders)
        items.write.mode("append").parquet(lines_at)
        landing.write.mode("append").parquet(orders_at)
        start_fact_upserts(
            spark.readStream.schema(items.schema).parquet(lines_at),
            staging.stg_orders(raw_orders(spark, known)),
            rates,
            products,
            partial(upsert_partitions, path),
            state,
            spark.readStream.schema(landing.schema).parquet(orders_at),
        ).awaitTermination()
        known += orders
        found = published.read(spark, path, FACT_SCHEMA).collect()
        assert {r.order_item_id: r.quantity for r in found} == wanted and len(found) == len(wanted)
    assert waiting.before(staging.stg_order_items(items).schema, 99).all().count() == 0
    replay = waiting.before(staging.stg_order_items(items).schema, 2)  # batch 2 released 3 and 4
    assert {r.order_id for r in replay.all().collect()} == {2, 3, 4, 5, 6, 7, 8}
    some = replay.of_orders(staging.stg_orders(raw_orders(spark, [order(4)])))
    assert {r.order_id for r in some.collect()} == {4} and len(some.inputFiles()) < 7


def test_newest_row_is_stream_state(spark, tmp_path):
    source, path, state = (str(tmp_path / n) for n in ("src", "latest", "state"))
    types = "id long, price int, changed_at timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    sent = []

    def load(rows):
        sent.append(as_rows(rows, "id", "price"))
        upsert_partitions(path, rows.withColumn("bucket", F.col("id") % 2), "id", "bucket", (), stamp="changed_at")

    for rows in ([(1, 10, day(1)), (2, 20, day(3)), (3, 30, day(1))], [(1, 11, day(2)), (2, 19, day(2))], []):
        spark.createDataFrame(rows, types).write.mode("append").parquet(source)
        start_latest(spark.readStream.schema(types).parquet(source), "id", ["changed_at", "price"], load, state).awaitTermination()
    # the late change of 2 is sent as its newest row; 3 is not touched again
    assert sent[:2] == [[(1, 10), (2, 20), (3, 30)], [(1, 11), (2, 20)]]
    assert as_rows(published.read(spark, path, spark.createDataFrame([], types).schema), "id", "price") == [(1, 11), (2, 20), (3, 30)]


def test_landing_and_latest(spark, tmp_path):
    source, landed, state = (str(tmp_path / n) for n in ("src", "landed", "state"))
    types = "id long, price int, changed_at timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    for rows in ([(1, 10, day(1)), (2, 20, day(1))], [(1, 11, day(2)), (1, 9, day(1))]):
        spark.createDataFrame(rows, types).write.mode("append").parquet(source)
        stream = spark.readStream.schema(types).parquet(source)
        start_landing(stream, "changed_at", landed, state).awaitTermination()
    changes = spark.read.parquet(landed)
    assert changes.count() == 4
    assert (tmp_path / "landed" / "extract_date=2024-01-02").exists()
    newest = latest_by_key(changes, "id", ["changed_at", "price"])
    assert as_rows(newest, "id", "price") == [(1, 11), (2, 20)]
