"""The nightly build: raw extracts in, star schema and reports out.

Tables live below one root, one folder per layer. Staging and intermediate models are
lazy functions; only marts and the product history are written.
"""

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import published
from starmart.fixed_values import CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY, EXPORT_COLUMNS
from starmart.operators import staging
from starmart.operators.history import History
from starmart.operators.quality import exceptions, raise_on_failure, run_tests
from starmart.operators.redo import lines_of_new_products, lines_to_rerate
from starmart.operators.upsert import high_water_mark, loaded_until, newer_than, upsert_partitions
from starmart.plans import dimensions, kept_totals
from starmart.plans.fact import fact_order_items
from starmart.schemas import AMOUNT, AMOUNT_USD, PRICE, RATE
from starmart.sources.sinks import write_report_csv
from starmart.storage import land, write_clustered

FACT_SCHEMA = T.StructType(
    [
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("order_date", T.TimestampNTZType()),
        T.StructField("order_hour", T.LongType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", PRICE),
        T.StructField("currency", T.StringType()),
        T.StructField("is_valid_currency", T.BooleanType()),
        T.StructField("line_amount_native", AMOUNT),
        T.StructField("rate_to_usd", RATE),
        T.StructField("line_amount_usd", AMOUNT_USD),
        T.StructField("is_fx_convertible", T.BooleanType()),
        T.StructField("is_unknown_product", T.BooleanType()),
        T.StructField("_loaded_at", T.TimestampNTZType()),
        T.StructField("order_date_day", T.DateType()),
    ]
)


@dataclass(frozen=True)
class Warehouse:
    """Where the written tables are."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def mart(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path("marts", table))

    def fact(self) -> DataFrame:
        """The fact as last published, whatever a load is writing now."""
        return published.read(self.spark, self.path("marts", "fact_order_items"), FACT_SCHEMA)

    def totals(self) -> DataFrame:
        """Totals per day, from which the reports are merged."""
        return kept_totals.read(self.spark, self.path("marts", "_kept_totals"))


def take_snapshot(wh: Warehouse, products: DataFrame, run_at: datetime) -> DataFrame:
    """Product history after this extract; only what changed is written.

    A run compares with the runs before it, so a rerun with the same ``run_at`` gives the
    same table.
    """
    log = History(wh.spark, wh.path("snapshots", "products"), products.schema)
    log.add(products, run_at)
    return log.versions(run_at)


def load_fact(
    wh: Warehouse,
    items: DataFrame,
    orders: DataFrame,
    rates: DataFrame,
    products: DataFrame,
    since: datetime | None = None,
) -> DataFrame:
    """Upsert the lines loaded after the newest stamp ever loaded, or after ``since``, and the
    lines that late rates and late products change.

    The stamp is published with the lines, so it never stands for lines that are not there.
    The rates and products of a load are published after its lines: a load that breaks off in
    between is compared with older ones the next time, and the same lines are redone. Returns
    the rows of the partitions that the load has written.
    """
    path = wh.path("marts", "fact_order_items")
    known_rates, known_products = (wh.path("marts", f"_loaded_with_{n}") for n in ("rates", "products"))
    rerated = None
    if published.versions(wh.spark, path):
        mark = since or loaded_until(wh.spark, path) or high_water_mark(wh.fact()).first()[0]
        due = newer_than(items, mark)
        if published.versions(wh.spark, known_products):
            before = published.read(wh.spark, known_products, products.schema)
            moved = lines_of_new_products(items, before, products)
            due = due.unionByName(moved.join(due.select("order_item_id"), "order_item_id", "left_anti").select(*items.columns))
        if published.versions(wh.spark, known_rates):
            before = published.read(wh.spark, known_rates, rates.schema)
            rerated = lines_to_rerate(path, FACT_SCHEMA, before, rates)
        items = due
    delta = fact_order_items(items, orders, rates, products)
    if rerated is not None:
        others = rerated.join(items.select("order_item_id"), "order_item_id", "left_anti")
        delta = delta.unionByName(others.select(*delta.columns))
    before = published.manifest(wh.spark, path)
    after = upsert_partitions(path, delta)
    published.replace_all(rates, known_rates)
    published.replace_all(products, known_products)
    written = [n for n, load in after.folders.items() if before.folders.get(n) != load]
    return published.read(wh.spark, path, FACT_SCHEMA, after.only(written))


def build(
    wh: Warehouse,
    raw: dict[str, DataFrame],
    run_at: datetime,
    since: datetime | None = None,
    calendar: tuple[date, date] = (CALENDAR_FIRST_DAY, CALENDAR_LAST_DAY),
    test_all: bool = False,
) -> DataFrame:
    """One run over raw extracts; returns the data tests and raises if one fails.

    ``calendar`` holds the first and last day of the date dimension. The fact is tested where
    the run has written it, or with ``test_all`` as a whole.
    """
    customers = staging.stg_customers(raw["raw_customers"])
    orders = staging.stg_orders(raw["raw_orders"])
    items = staging.stg_order_items(raw["raw_order_items"])
    rates = staging.stg_fx_rates(raw["raw_fx_rates"])
    products = staging.stg_products(raw["raw_products"])

    history = take_snapshot(wh, products, run_at)
    _replace(wh, "dim_products", dimensions.dim_products(history))
    _replace(wh, "dim_customers", dimensions.dim_customers(customers))
    _replace(wh, "dim_date", dimensions.dim_date(wh.spark, *calendar))
    _replace(wh, "dim_time_of_day", dimensions.dim_time_of_day(wh.spark))
    written = load_fact(wh, items, orders, rates, wh.mart("dim_products"), since)
    refresh_totals(wh)

    tests = run_tests(
        {
            "stg_customers": customers,
            "stg_orders": orders,
            "stg_order_items": items,
            "stg_products": products,
            "stg_fx_rates": rates,
            "dim_customers": wh.mart("dim_customers"),
            "dim_products": wh.mart("dim_products"),
            "dim_date": wh.mart("dim_date"),
            "dim_time_of_day": wh.mart("dim_time_of_day"),
            "fact_order_items": wh.fact(),
        },
        touched=None if test_all else {"fact_order_items": written},
    )
    results = land(tests, "data_tests")
    raise_on_failure(results)
    return results


def refresh_totals(wh: Warehouse) -> published.Manifest:
    """Redo the kept totals of the days that the newest loads have written."""
    fact, totals = (wh.path("marts", n) for n in ("fact_order_items", "_kept_totals"))
    return kept_totals.refresh(wh.spark, fact, FACT_SCHEMA, totals)


def _replace(wh: Warehouse, table: str, df: DataFrame) -> None:
    df.write.mode("overwrite").parquet(wh.path("marts", table))


def write_raw_orders(wh: Warehouse, raw: DataFrame) -> None:
    """Raw orders by day, clustered by customer."""
    dated = land(raw.withColumn("order_day", F.col("order_date").cast("date")), "raw_orders")
    write_clustered(
        dated, wh.path("raw", "orders"), "order_day", ("customer_id",), "id", mode="overwrite"
    )


def export_reports(wh: Warehouse, folder: str) -> None:
    """The four report files; only the list of exceptions reads lines."""
    totals = wh.totals()
    made = {
        "rpt_top_products": kept_totals.top_products(totals, wh.mart("dim_products")),
        "rpt_promo_time_of_day": kept_totals.promo_time_of_day(totals, wh.mart("dim_time_of_day")),
        "rpt_data_quality_exceptions": exceptions(wh.fact()),
        "kpis_summary": kept_totals.kpis(totals),
    }
    for name, report in made.items():
        export_report(report, name, f"{folder}/{name}")


def export_report(report: DataFrame, name: str, path: str) -> None:
    """One published file. Only reports of fixed size become a single part."""
    order = {
        "rpt_top_products": [F.col("revenue_usd").desc_nulls_last(), F.col("product_id")],
        "rpt_promo_time_of_day": [F.col("hour_of_day")],
        "rpt_data_quality_exceptions": [F.col("order_date"), F.col("order_item_id")],
        "kpis_summary": [],
    }[name]
    fixed_size = name in ("rpt_promo_time_of_day", "kpis_summary")
    write_report_csv(report, path, list(EXPORT_COLUMNS[name]), order, fixed_size)
