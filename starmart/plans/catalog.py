"""Named queries over the given tables; each covers whole tables.

Results use plain types (bigint, double) so that any SQL engine can be compared.
"""

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import published, schemas
from starmart.fixed_values import EXPORT_COLUMNS, UNKNOWN_PRODUCT_ID
from starmart.functions.calendar import local_time
from starmart.operators import asof, ordering, quality, redo, scd2, staging, upsert
from starmart.operators.colocated import Colocated
from starmart.operators.history import History
from starmart.operators.latest import latest_by_key
from starmart.operators.skew import join_spread
from starmart.plans import dimensions, fact, inputs, kept_totals, reports
from starmart.plans.fact import LINE_KEY
from starmart.plans.warehouse import export_report
from starmart.sources import landing, readers
from starmart.storage import land, new_path
from starmart.streaming.change_stream import start_landing
from starmart.streaming.fact_stream import start_fact_upserts
from starmart.streaming.latest_stream import start_latest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(*[_plain(field) for field in df.schema.fields])

    QUERIES[fn.__name__] = plain
    return fn


def _plain(field: T.StructField):
    column = F.col(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("double").alias(field.name)
    if isinstance(field.dataType, T.IntegerType):
        return column.cast("long").alias(field.name)
    return column


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared inputs ------------------------------------------------------------------


def _items(spark, d):
    return staging.stg_order_items(inputs.raw_order_items(spark, d))


def _orders(spark, d):
    return staging.stg_orders(inputs.raw_orders(spark, d))


def _some_lines_without_order(spark, d):
    """All lines; those of some orders name an order that does not exist."""
    order = F.col("order_id")
    strayed = F.when(order % 50 == 7, order + inputs.OUTSIDE).otherwise(order)
    return _items(spark, d).withColumn("order_id", strayed)


def _rates(spark, d):
    return staging.stg_fx_rates(inputs.raw_fx_rates(spark, d))


def _products(spark, d):
    staged = staging.stg_products(inputs.raw_products(spark, d))
    return dimensions.dim_products(scd2.first_snapshot(staged, inputs.FIRST_EXTRACT_AT))


def _fact(spark, d, items=None, rates=None):
    items = _items(spark, d) if items is None else items
    rates = _rates(spark, d) if rates is None else rates
    return fact.fact_order_items(items, _orders(spark, d), rates, _products(spark, d))


def _landed_fact(spark, d, rates=None):
    """The fact as a written mart, for queries that read it more than once."""
    return land(_fact(spark, d, rates=rates), "fact_order_items")


def _first_load(spark, d):
    """Fact lines of the first batch."""
    early = _items(spark, d).filter(F.col("_loaded_at") == local_time(inputs.BATCH_1_LOADED_AT))
    return _fact(spark, d, early)


def _second_delta(spark, d, target):
    """Fact lines of the second extract that are newer than the target."""
    mark = upsert.high_water_mark(target).first()[0]
    again = staging.stg_order_items(inputs.redelivered_items(spark, d))
    return _fact(spark, d, upsert.newer_than(again, mark))


# --- sources and landing ------------------------------------------------------------


@query
def raw_scan_typed(spark, d):
    path = new_path(spark, "raw_order_items_csv")
    (
        inputs.raw_order_items(spark, d)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return readers.read_csv(spark, path, schemas.RAW_ORDER_ITEMS)


@query
def raw_contract(spark, d):
    """NULLs per required column of all five raw tables."""
    raw = {
        "raw_customers": inputs.raw_customers,
        "raw_orders": inputs.raw_orders,
        "raw_order_items": inputs.raw_order_items,
        "raw_products": inputs.raw_products,
        "raw_fx_rates": inputs.raw_fx_rates,
    }
    found = [
        readers.contract_violations(make(spark, d), schemas.RAW_TABLES[name]).withColumn(
            "table_name", F.lit(name)
        )
        for name, make in raw.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query
def fx_json_flatten(spark, d):
    path = new_path(spark, "fx_json")
    rates = inputs.raw_fx_rates(spark, d)
    # one API answer per document: a base currency and a day with its quotes
    answers = rates.groupBy("base_currency", "rate_date").agg(
        F.map_from_entries(F.collect_list(F.struct("quote_currency", "rate"))).alias("rates")
    )
    answer = F.struct(
        F.col("base_currency").alias("base"), F.col("rate_date").alias("date"), "rates"
    )
    answers.select(F.array(answer).alias("responses")).write.json(path)
    documents = spark.read.schema(schemas.FX_RESPONSES).json(path)
    return readers.flatten_fx_responses(documents)


@query
def assign_sequential_id(spark, d):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    lines = inputs.table(spark, d, "lineitem").select(*columns, "l_quantity")
    return ordering.assign_sequential_id(lines, "id", columns)


@query
def stamp_loaded_at(spark, d):
    orders = inputs.raw_orders(spark, d).drop("_loaded_at")
    return landing.stamp_loaded_at(orders, "id", _cutoff(orders)).select(
        "id", "customer_id", "order_date", "_loaded_at"
    )


@query
def batch_split_semi(spark, d):
    orders, items = inputs.raw_orders(spark, d), inputs.raw_order_items(spark, d)
    _, early = landing.first_batch(orders, items, _cutoff(orders))
    return early


@query
def batch_split_orders(spark, d):
    """The other half of the split: the orders of the first batch."""
    orders, items = inputs.raw_orders(spark, d), inputs.raw_order_items(spark, d)
    early, _ = landing.first_batch(orders, items, _cutoff(orders))
    return early


def _cutoff(orders: DataFrame) -> int:
    """Two thirds of the order ids."""
    return orders.agg(F.max("id")).first()[0] * 2 // 3


# --- staging ------------------------------------------------------------------------


@query
def stg_customers(spark, d):
    return staging.stg_customers(inputs.raw_customers(spark, d))


@query
def stg_products(spark, d):
    return staging.stg_products(inputs.raw_products(spark, d))


@query
def stg_orders(spark, d):
    return _orders(spark, d)


@query
def stg_order_items(spark, d):
    return _items(spark, d)


@query
def stg_fx_rates(spark, d):
    return _rates(spark, d)


# --- currency conversion ------------------------------------------------------------


@query
def fx_asof_interval(spark, d):
    dated = fact.dated_lines(_items(spark, d), _orders(spark, d))
    rated = asof.join_nearest(
        dated,
        _rates(spark, d),
        key="currency",
        line_day=F.col("order_date").cast("date"),
        day="rate_date",
        value="rate_to_usd",
        spread_by=LINE_KEY,
    )
    return rated.select("order_item_id", "currency", "order_date", "rate_to_usd")


@query
def fx_asof_ranked(spark, d):
    """Every convertible line with its best-ranked rate; ranked per currency and day."""
    order_day = F.col("order_date").cast("date").alias("order_day")
    dated = fact.dated_lines(_items(spark, d), _orders(spark, d))
    lines = land(dated.select("order_item_id", "currency", order_day), "dated_lines")
    ranked = asof.rank_nearest(
        lines, _rates(spark, d), "currency", "order_day", "rate_date", "rate_to_usd"
    )
    return join_spread(lines, ranked, ["currency", "order_day"], "inner", LINE_KEY).select(
        "order_item_id", "currency", "order_day", "rate_to_usd", "is_future", "days_apart"
    )


@query
def order_items_usd(spark, d):
    items = _some_lines_without_order(spark, d)
    return fact.order_items_usd(items, _orders(spark, d), _rates(spark, d))


@query
def order_items_usd_inner(spark, d):
    items = _some_lines_without_order(spark, d)
    return fact.order_items_usd(items, _orders(spark, d), _rates(spark, d), "inner")


# --- marts --------------------------------------------------------------------------


@query
def fact_order_items(spark, d):
    return _fact(spark, d)


@query
def fact_colocated(spark, d):
    """The fact from lines and orders written side by side, in two batches."""
    items, orders = _items(spark, d), _orders(spark, d)
    pair = Colocated(
        spark, new_path(spark, "colocated"), items.schema, orders.schema, "order_id", LINE_KEY, buckets=8
    )
    early = F.col("_loaded_at") == local_time(inputs.BATCH_1_LOADED_AT)
    pair.add(items.filter(early), orders.filter(early), "1")
    pair.add(items.filter(~early), orders.filter(~early), "2")
    return fact.fact_of_pair(pair, _rates(spark, d), _products(spark, d))


@query
def fact_partition_pruned(spark, d):
    """The fact written by month, then one quarter read back by directory pruning."""
    path = new_path(spark, "fact_by_month")
    by_month = _fact(spark, d).withColumn("order_month", F.trunc("order_date_day", "month"))
    upsert.upsert_partitions(path, by_month, partition_by="order_month")
    quarter = F.col("order_month").between(
        F.lit("1998-01-01").cast("date"), F.lit("1998-03-01").cast("date")
    )
    written = published.read(spark, path, by_month.schema).filter(quarter)
    return written.groupBy("order_date_day").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.round(F.sum("line_amount_usd"), 2).alias("revenue_usd"),
    )


@query
def dim_customers(spark, d):
    return dimensions.dim_customers(staging.stg_customers(inputs.raw_customers(spark, d)))


@query
def dim_products(spark, d):
    return dimensions.dim_products(_two_snapshots(spark, d))


@query
def dim_date(spark, d):
    """The calendar of the order period with the orders of each day."""
    per_day = (
        inputs.raw_orders(spark, d)
        .groupBy(F.col("order_date").cast("date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    span = per_day.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last")).first()
    calendar = dimensions.dim_date(spark, span.first, span.last)
    return calendar.join(per_day, "date_day", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


@query
def dim_time_of_day(spark, d):
    """The 24 hours with the orders placed in each."""
    per_hour = (
        inputs.raw_orders(spark, d)
        .groupBy(F.hour("order_date").cast("long").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    hours = dimensions.dim_time_of_day(spark)
    return hours.join(per_hour, "hour_of_day", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


# --- reports ------------------------------------------------------------------------


@query
def orders_hourly(spark, d):
    return _rounded(reports.orders_hourly(_fact(spark, d)), 2, "order_revenue_usd")


@query
def rpt_top_products(spark, d):
    report = reports.top_products(_fact(spark, d), _products(spark, d))
    return _rounded(report, 2, "revenue_usd")


@query
def top10_products(spark, d):
    report = reports.top_products(_fact(spark, d), _products(spark, d))
    return _rounded(reports.best_sellers(report, 10), 2, "revenue_usd")


@query
def rank_lines_by_amount(spark, d):
    """The distributed rank, over every line."""
    lines = _items(spark, d).select("order_item_id", "line_amount_native", "quantity")
    ranks = {"rank_by_amount": "line_amount_native", "rank_by_quantity": "quantity"}
    return ordering.rank_all(lines, ranks, LINE_KEY)


@query
def rpt_promo_time_of_day(spark, d):
    report = reports.promo_time_of_day(_fact(spark, d), dimensions.dim_time_of_day(spark))
    return _rounded(report, 2, "revenue_usd", "avg_order_value_usd")


@query
def rpt_promo_line_grain(spark, d):
    report = reports.promo_by_line(_fact(spark, d), dimensions.dim_time_of_day(spark))
    return _rounded(report, 2, "revenue_usd")


@query
def promo_purchase_events(spark, d):
    """The best-hour report over shop events; only purchases bring revenue."""
    events = inputs.table(spark, d, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.hour("ts").cast("long").alias("order_hour"),
        (F.col("event_type") == "purchase").alias("is_fx_convertible"),
        F.col("value").cast(schemas.AMOUNT).alias("line_amount_usd"),
    )
    report = reports.promo_time_of_day(events, dimensions.dim_time_of_day(spark))
    return _rounded(report, 2, "revenue_usd", "avg_order_value_usd")


@query
def rpt_dq_exceptions(spark, d):
    return quality.exceptions(_fact(spark, d))


def _exported(spark, report: DataFrame, name: str) -> DataFrame:
    """The published file as written, read back with the report's types."""
    path = new_path(spark, name)
    export_report(report, name, path)
    schema = report.select(*EXPORT_COLUMNS[name]).schema
    return spark.read.schema(schema).option("header", True).csv(path)


@query
def export_top_products(spark, d):
    report = reports.top_products(_fact(spark, d), _products(spark, d))
    return _rounded(_exported(spark, report, "rpt_top_products"), 2, "revenue_usd")


@query
def export_promo(spark, d):
    report = reports.promo_time_of_day(_fact(spark, d), dimensions.dim_time_of_day(spark))
    return _rounded(_exported(spark, report, "rpt_promo_time_of_day"), 2, "revenue_usd")


@query
def export_kpis(spark, d):
    return _exported(spark, reports.kpis(_fact(spark, d)), "kpis_summary")


@query
def export_dq_exceptions(spark, d):
    report = quality.exceptions(_fact(spark, d))
    written = _exported(spark, report, "rpt_data_quality_exceptions")
    # a CSV file does not tell "no reason" from NULL; the report has no NULL here
    return written.fillna("", "exception_reasons")


@query
def kpis_summary(spark, d):
    return _rounded(reports.kpis(_fact(spark, d)), 8, "flagged_line_rate")


# --- incremental load ---------------------------------------------------------------


@query
def high_water_mark(spark, d):
    items = _items(spark, d)
    loaded = upsert.high_water_mark(items).withColumn("target", F.lit("loaded"))
    empty = upsert.high_water_mark(items.filter(F.col("_loaded_at").isNull()))
    return loaded.unionByName(empty.withColumn("target", F.lit("empty")))


@query
def incremental_delta(spark, d):
    mark = upsert.high_water_mark(_first_load(spark, d)).first()[0]
    return upsert.newer_than(_items(spark, d), mark)


def _quarter(day: str):
    return F.trunc(day, "quarter")


def _by_quarter(fact: DataFrame) -> DataFrame:
    return fact.withColumn("order_quarter", _quarter("order_date_day"))


def _apply(path: str, delta: DataFrame, **options) -> None:
    """Upsert into a fact kept by quarter (the tables are small for one folder per day)."""
    upsert.upsert_partitions(path, _by_quarter(delta), partition_by="order_quarter", **options)


def _published(spark, path: str, like: DataFrame) -> DataFrame:
    """The columns of the published fact, ``like`` a delta of it."""
    return published.read(spark, path, _by_quarter(like).schema).select(*schemas.FACT_COLUMNS)


@query
def fact_incremental(spark, d):
    """First load, then the second extract applied by quarter; the written table."""
    path = new_path(spark, "fact_incremental")
    first = _first_load(spark, d)
    _apply(path, first)
    _apply(path, _second_delta(spark, d, _published(spark, path, first)))
    return _published(spark, path, first)


@query
def fact_merge(spark, d):
    """The same two loads with the column-subset merge."""
    path = new_path(spark, "fact_merge")
    first = _first_load(spark, d)
    _apply(path, first)
    delta = _second_delta(spark, d, _published(spark, path, first))
    _apply(path, delta, merge=upsert.merge_columns)
    return _published(spark, path, first)


@query
def fact_corrected(spark, d):
    """The fact of all lines; then the hundred dearest come again with one more unit, and are
    looked up by their ids, which are digests."""
    path = new_path(spark, "fact_corrected")
    first = _fact(spark, d)
    _apply(path, first, unordered_key=True)
    loaded = _published(spark, path, first)
    dearest = loaded.orderBy(F.col("line_amount_native").desc_nulls_last(), "order_item_id").limit(100)
    _apply(path, dearest.withColumn("quantity", F.col("quantity") + 1), unordered_key=True)
    return _published(spark, path, first)


@query
def fact_rerated(spark, d):
    """The fact of all lines, loaded with every second rate missing; then the late rates arrive
    and the lines they change are redone."""
    path, rates = new_path(spark, "fact_rerated"), _rates(spark, d)
    early = land(rates.filter(F.dayofyear("rate_date") % 2 == 0), "early_rates")
    first = _fact(spark, d, rates=early)
    _apply(path, first)
    schema = _by_quarter(first).schema
    late = redo.lines_to_rerate(path, schema, early, rates, "order_quarter", _quarter("_day"))
    _apply(path, late)
    return _published(spark, path, first)


def _kept_after_two_loads(spark, d, name: str) -> DataFrame:
    """Totals by quarter, refreshed after each of the loads of ``fact_incremental``."""
    path, kept = new_path(spark, name), new_path(spark, f"{name}_totals")
    first = _first_load(spark, d)
    _apply(path, first)
    schema = _by_quarter(first).schema
    kept_totals.refresh(spark, path, schema, kept, "order_quarter")
    _apply(path, _second_delta(spark, d, _published(spark, path, first)))
    kept_totals.refresh(spark, path, schema, kept, "order_quarter")
    return kept_totals.read(spark, kept)


@query
def kept_top_products(spark, d):
    kept = _kept_after_two_loads(spark, d, "kept_top_products")
    return _rounded(kept_totals.top_products(kept, _products(spark, d)), 2, "revenue_usd")


@query
def kept_promo_time_of_day(spark, d):
    kept = _kept_after_two_loads(spark, d, "kept_promo")
    report = kept_totals.promo_time_of_day(kept, dimensions.dim_time_of_day(spark))
    return _rounded(report, 2, "revenue_usd", "avg_order_value_usd")


@query
def kept_kpis(spark, d):
    kept = _kept_after_two_loads(spark, d, "kept_kpis")
    return _rounded(kept_totals.kpis(kept), 8, "flagged_line_rate")


@query
def schema_sync(spark, d):
    """First-batch lines without an amount column, given the later columns."""
    items = _items(spark, d)
    mark = local_time(inputs.BATCH_1_LOADED_AT)
    old = items.filter(F.col("_loaded_at") == mark).drop("line_amount_native")
    old = old.withColumn("legacy_code", F.col("currency"))
    new = items.filter(F.col("_loaded_at") > mark)
    return upsert.sync_schema(old, new.schema).unionByName(new)


# --- product history ----------------------------------------------------------------


def _two_snapshots(spark, d):
    first = staging.stg_products(inputs.raw_products(spark, d))
    second = staging.stg_products(inputs.second_raw_products(spark, d))
    log = History(spark, new_path(spark, "product_history"), first.schema)
    log.add(first, inputs.FIRST_EXTRACT_AT)
    log.add(second, inputs.SECOND_EXTRACT_AT)
    return log.versions()


def _native_history(spark, d):
    raw = inputs.raw_product_history(spark, d)
    staged = raw.select(
        F.col("id").alias("product_id"),
        F.trim("name").alias("product_name"),
        F.trim("category").alias("category"),
        "description",
        "base_price",
        F.upper(F.trim("currency")).alias("currency"),
        "valid_from",
        "valid_to",
    )
    return scd2.from_native_history(staged, inputs.OPEN_END)


@query
def scd2_snapshot(spark, d):
    return _two_snapshots(spark, d)


@query
def scd2_from_native(spark, d):
    return dimensions.dim_products(_native_history(spark, d))


@query
def pit_product_join(spark, d):
    """Every line with the product version that was valid when it was ordered."""
    orders = _orders(spark, d)
    dated = fact.dated_lines(_items(spark, d), orders)
    return scd2.join_valid_at(
        dated.select("order_item_id", "product_id", "order_date", "unit_price"),
        _native_history(spark, d),
        key="product_id",
        at="order_date",
        attributes={"list_price": "base_price", "version_from": "valid_from"},
        spread_by=LINE_KEY,
        dates_in=orders,
    )


# --- data quality -------------------------------------------------------------------


@query
def dq_tests(spark, d):
    orders = _orders(spark, d)
    span = orders.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last")).first()
    customers = staging.stg_customers(inputs.raw_customers(spark, d))
    rates = _rates(spark, d)
    return quality.run_tests(
        {
            "stg_customers": customers,
            "stg_orders": orders,
            "stg_order_items": _items(spark, d),
            "stg_products": staging.stg_products(inputs.raw_products(spark, d)),
            "stg_fx_rates": rates,
            "dim_customers": dimensions.dim_customers(customers),
            "dim_products": land(dimensions.dim_products(_two_snapshots(spark, d)), "dim_products"),
            "dim_date": dimensions.dim_date(spark, span.first.date(), span.last.date()),
            "dim_time_of_day": dimensions.dim_time_of_day(spark),
            "fact_order_items": _landed_fact(spark, d, rates),
        }
    )


@query
def dq_rate_anomaly(spark, d):
    rates = quality.exception_rate_by_day(_fact(spark, d))
    return _rounded(rates, 8, "exception_rate", "usual_rate", "usual_deviation")


@query
def reconcile_totals(spark, d):
    lines, products = _landed_fact(spark, d), _products(spark, d)
    totals = quality.reconcile(lines, reports.top_products(lines, products))
    return _rounded(totals, 2, "fact_revenue_usd", "reported_revenue_usd", "unknown_revenue_usd")


@query
def unknown_product_bucket(spark, d):
    """What the placeholder product has collected, by currency."""
    unknown = _fact(spark, d).filter(F.col("product_id") == UNKNOWN_PRODUCT_ID)
    return unknown.groupBy("currency").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("units"),
        F.round(F.sum("line_amount_usd"), 2).alias("revenue_usd"),
    )


# --- streaming ----------------------------------------------------------------------


@query
def landing_latest_by_key(spark, d):
    """Price changes streamed into the landing table, then the newest per product."""
    # a glob, because a stream's plain path must be a folder and the table may be a file
    lines = spark.readStream.schema(inputs.table(spark, d, "lineitem").schema).parquet(
        f"{d}/lineitem.parquet*"
    )
    path, checkpoint = new_path(spark, "landing"), new_path(spark, "landing_state")
    start_landing(
        inputs.raw_product_changes(lines), "extracted_at", path, checkpoint
    ).awaitTermination()
    changes = spark.read.parquet(path)
    return latest_by_key(changes, "product_id", ["changed_at", "change_id"])


def _in_runs(spark, runs: dict[str, list[DataFrame]]):
    """Write the next part of each table beside the earlier ones; yields a stream per table."""
    paths = {name: new_path(spark, name) for name in runs}
    for parts in zip(*runs.values()):
        for part, path in zip(parts, paths.values()):
            part.write.mode("append").parquet(path)
        yield [
            spark.readStream.schema(part.schema).parquet(path)
            for part, path in zip(parts, paths.values())
        ]


@query
def latest_stream_state(spark, d):
    """All price changes streamed in two runs; each run sends the newest row of its products."""
    changes = inputs.raw_product_changes(inputs.table(spark, d, "lineitem"))
    is_late = F.col("change_id") % 3 == 0  # whatever its stamp
    path, checkpoint = new_path(spark, "latest"), new_path(spark, "latest_state")

    def load(rows: DataFrame) -> None:
        bucketed = rows.withColumn("bucket", (F.col("product_id") % 16).cast("int"))
        upsert.upsert_partitions(path, bucketed, "product_id", "bucket", (), stamp="changed_at")

    for [stream] in _in_runs(spark, {"changes": [changes.filter(~is_late), changes.filter(is_late)]}):
        start_latest(stream, "product_id", ["changed_at", "change_id"], load, checkpoint).awaitTermination()
    return published.read(spark, path, changes.schema)


@query
def stream_fact_upsert(spark, d):
    """Raw lines and orders streamed into the fact in three runs.

    The second run corrects some lines and brings some lines of the first batch late, with
    their old stamp; the third has no lines, only the orders that were missing.
    """
    path, checkpoint = new_path(spark, "fact_stream"), new_path(spark, "fact_stream_state")
    all_first = inputs.raw_order_items(spark, d).filter(
        F.col("_loaded_at") == local_time(inputs.BATCH_1_LOADED_AT)
    )
    is_late, is_missing = F.col("product_id") % 7 == 3, F.col("id") % 11 == 4
    first = all_first.filter(~is_late)
    second = inputs.redelivered_items(spark, d).filter(
        F.col("_loaded_at") > local_time(inputs.BATCH_1_LOADED_AT)
    )
    second = second.unionByName(all_first.filter(is_late))
    orders, rates, products = inputs.raw_orders(spark, d), _rates(spark, d), _products(spark, d)
    landing = {
        "raw_items": [first, second, first.filter("false")],
        "raw_orders": [orders.filter(~is_missing), orders.filter("false"), orders.filter(is_missing)],
    }
    known = staging.stg_orders(orders.filter("false"))
    for run, (items, arriving) in enumerate(_in_runs(spark, landing)):
        if run:
            known = staging.stg_orders(orders.filter(~is_missing))
        start_fact_upserts(
            items, known, rates, products, partial(_apply, path), checkpoint, arriving, 8
        ).awaitTermination()
    return _published(spark, path, _first_load(spark, d))
