"""Totals kept per period beside the fact, from which the reports are merged.

A refresh compares the folders of the published fact with those it was built from, reads only
the periods that differ, and publishes their totals as the next version; one that breaks off has
changed nothing, and a repeated one does nothing. Reports then read the totals and no line.

Sums are added up. Distinct orders cannot be, so their ids are kept as sets that can be merged,
cut into buckets of 32,768 ids: bitmaps per hour, where a bucket is well filled, and sorted lists
of two-byte positions per product, where it is not (a bitmap would spend 4 KB on a few orders). An
order that shows up in two periods counts once. The size of a cell is bounded by its bucket; a
product or hour that owns a third of all lines has more buckets, not larger ones. The sums of a
product stand beside its sets, so that its lines are moved once.

A refresh moves lines to their cells by range and writes what it adds up there as it lies: nothing
is computed twice, and the files are as narrow as if they had been sorted afterwards. If a cell may
have more lines than a task should, each task adds up its own lines before any is moved.

Lines of the fact always have an order. Placeholder products are in the totals, without a set of
orders, because no report asks for them.
"""

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import published, storage
from starmart.fixed_values import UNKNOWN_PRODUCT_ID
from starmart.functions.money import convertible_usd
from starmart.operators.quality import is_exception
from starmart.plans import reports

BUILT_FROM = "built_from"  # the manifest's note of the fact's folders

_SORT_AGGREGATE = "spark.sql.execution.replaceHashWithSortAgg"

# PRODUCTS are the sums of lines without a set of orders
PRODUCTS, PRODUCT_ORDERS, HOURS = "products", "product_orders", "hours"

# ``member`` is a product id or an hour, by kind; columns that a kind has no use for are NULL
COLUMNS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("member", T.LongType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("units", T.LongType()),
        T.StructField("revenue_usd", T.DecimalType(38, 8)),
        T.StructField("lines", T.LongType()),
        T.StructField("exceptions", T.LongType()),
        T.StructField("positions", T.ArrayType(T.ShortType())),
        T.StructField("bits", T.BinaryType()),
        T.StructField("paid_bits", T.BinaryType()),
    ]
)


def totals(fact: DataFrame, period: str, tasks: int | None = None, move_lines: bool = False) -> DataFrame:
    """All kinds of totals of the given lines; cut by ranges into ``tasks`` parts, if given.

    With ``move_lines`` a task gets all lines of its cells; otherwise each task adds up its own
    lines before any is moved, however many a cell has.
    """
    bucket = F.bitmap_bucket_number("order_id").alias("bucket")
    position = F.bitmap_bit_position("order_id")
    usd = convertible_usd().alias("usd")
    lines = fact.select(
        period, "product_id", "order_hour", bucket, position.alias("position"), "quantity", usd, is_exception().alias("exception")
    )
    sums = [
        F.sum("quantity").alias("units"),
        F.sum("usd").alias("revenue_usd"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if("exception").alias("exceptions"),
    ]
    orders = [*sums, F.sort_array(F.collect_set(F.col("position").cast("short"))).alias("positions")]
    hours = [
        F.sum("usd").alias("revenue_usd"),
        F.bitmap_construct_agg("position").alias("bits"),
        F.bitmap_construct_agg(F.when(F.col("usd").isNotNull(), F.col("position"))).alias("paid_bits"),
    ]
    of_product, of_hour = lines.withColumnRenamed("product_id", "member"), lines.withColumnRenamed("order_hour", "member")
    is_real = F.coalesce(F.col("member") != UNKNOWN_PRODUCT_ID, F.lit(False))
    # few rows: one per period and task
    others = of_product.filter(~is_real).groupBy(period, "member").agg(*sums)
    if tasks:
        others = others.repartitionByRange(1, period)
    kinds = [
        (PRODUCTS, others),
        (PRODUCT_ORDERS, _per_cell(of_product.filter(is_real).drop("order_hour"), period, orders, tasks, move_lines)),
        (HOURS, _per_cell(of_hour.select(period, "member", "bucket", "position", "usd"), period, hours, tasks, move_lines)),
    ]
    first, *rest = [_as_kind(df, kind, period) for kind, df in kinds]
    for other in rest:
        first = first.unionByName(other)
    return first


def _per_cell(lines: DataFrame, period: str, aggregates: list[Column], tasks: int | None, move_lines: bool) -> DataFrame:
    """One row per period, member and bucket."""
    cell = [period, "member", "bucket"]
    if tasks and move_lines:
        return lines.repartitionByRange(tasks, *cell).sortWithinPartitions(*cell).groupBy(*cell).agg(*aggregates)
    cells = lines.groupBy(*cell).agg(*aggregates)
    return cells.repartitionByRange(tasks, *cell) if tasks else cells


def _lines_and_most(lines: DataFrame, period: str) -> tuple[int, int]:
    """How many lines there are, and the most that any cell can have: no product and no hour has
    more lines in a bucket of orders than the bucket itself."""
    per_bucket = lines.groupBy(period, F.bitmap_bucket_number("order_id").alias("bucket")).count()
    row = per_bucket.agg(F.sum("count").alias("lines"), F.max("count").alias("most")).first()
    return row.lines or 0, row.most or 0


def _as_kind(df: DataFrame, kind: str, period: str) -> DataFrame:
    named = df.withColumn("kind", F.lit(kind))
    columns = [
        (F.col(f.name) if f.name in named.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in COLUMNS.fields
    ]
    return named.select(period, *columns)


def refresh(
    spark: SparkSession,
    fact_path: str,
    fact_schema: T.StructType,
    path: str,
    period: str = "order_date_day",
) -> published.Manifest:
    """Bring the totals at ``path`` up to the newest version of the fact.

    ``period`` is the column by which the fact is partitioned. Returns the current manifest.
    """
    now, before = published.manifest(spark, fact_path), published.manifest(spark, path)
    known = json.loads(before.notes.get(BUILT_FROM, "{}"))
    changed = {n for n in now.folders.keys() | known.keys() if now.folders.get(n) != known.get(n)}
    if not changed:
        return before
    lines = published.read(spark, fact_path, fact_schema, now.only(changed))
    load = published.new_load()
    rows, most = _lines_and_most(lines, period)
    # a task sorts its lines, and then its totals: at most one of each kind per line
    tasks = storage.tasks_of(spark, 2 * rows, len(changed))
    found = totals(lines, period, tasks, move_lines=most <= storage.ROWS_PER_TASK // 2)
    with _in_order(spark):
        storage.write_as_cut(found, published.load_path(path, load), period, ("kind", "member"), "bucket")
    return published.publish(spark, path, before, changed, load, {BUILT_FROM: json.dumps(now.folders)})


@contextmanager
def _in_order(spark: SparkSession) -> Iterator[None]:
    """Rows that lie in the order of their cells are added up as they come. By default, an aggregate
    that makes sets hashes a few cells and sorts all others, before and after it adds up."""
    before = spark.conf.get(_SORT_AGGREGATE)
    spark.conf.set(_SORT_AGGREGATE, True)
    try:
        yield
    finally:
        spark.conf.set(_SORT_AGGREGATE, before)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The totals as last published, over all periods."""
    return published.read(spark, path, COLUMNS)


def _of_kind(kept: DataFrame, kind: str) -> DataFrame:
    return kept.filter(F.col("kind") == kind)


def product_totals(kept: DataFrame) -> DataFrame:
    """Units, revenue and orders per real product, as ``reports.product_totals`` of the fact."""
    rows = kept.filter(F.col("kind").isin(PRODUCTS, PRODUCT_ORDERS) & (F.col("member") != UNKNOWN_PRODUCT_ID))
    # an order that has several periods is there several times; the sums go with the first one of a set
    places = rows.repartition("member", "bucket").select(
        "member", "bucket", "units", "revenue_usd", F.posexplode_outer("positions").alias("place", "position")
    )
    is_first = F.coalesce(F.col("place"), F.lit(0)) == 0
    once = places.groupBy("member", "bucket", "position").agg(
        F.sum(F.when(is_first, F.col("units"))).alias("units"),
        F.sum(F.when(is_first, F.col("revenue_usd"))).alias("revenue_usd"),
    )
    merged = once.groupBy("member").agg(
        F.sum("units").alias("units_sold"),
        F.sum("revenue_usd").alias("revenue_usd"),
        F.count("position").alias("order_count"),
    )
    return merged.withColumnRenamed("member", "product_id")


def _hour_buckets(kept: DataFrame, *by: str) -> DataFrame:
    return _of_kind(kept, HOURS).groupBy(*by, "bucket").agg(
        F.sum("revenue_usd").alias("revenue_usd"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("orders"),
        F.bitmap_count(F.bitmap_or_agg("paid_bits")).alias("paid"),
    )


def top_products(kept: DataFrame, products: DataFrame) -> DataFrame:
    """``reports.top_products`` without a line read."""
    return reports.rank_products(product_totals(kept), products)


def promo_time_of_day(kept: DataFrame, hours: DataFrame) -> DataFrame:
    """``reports.promo_time_of_day`` without a line read."""
    per_hour = (
        _hour_buckets(kept, "member")
        .groupBy(F.col("member").alias("order_hour"))
        .agg(
            F.sum("orders").alias("order_count"),
            F.sum("revenue_usd").alias("revenue_usd"),
            F.try_divide(F.sum("revenue_usd"), F.sum("paid")).alias("avg_order_value_usd"),
        )
    )
    return reports.rank_hours(per_hour, hours)


def kpis(kept: DataFrame) -> DataFrame:
    """``reports.kpis`` without a line read; two aggregates of one row each are joined."""
    sums = kept.filter(F.col("kind").isin(PRODUCTS, PRODUCT_ORDERS)).agg(
        F.round(F.sum("revenue_usd"), 2).alias("total_revenue_usd"),
        F.sum("units").alias("total_units"),
        F.coalesce(F.sum("exceptions"), F.lit(0)).alias("dq_exceptions"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_lines"),
    )
    orders = _hour_buckets(kept).agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"))
    return (
        sums.withColumn("_one", F.lit(1))
        .join(F.broadcast(orders.withColumn("_one", F.lit(1))), "_one")
        .withColumn("flagged_line_rate", F.try_divide("dq_exceptions", "total_lines"))
        .select("total_revenue_usd", "total_units", "total_orders", "dq_exceptions", "total_lines", "flagged_line_rate")
    )
