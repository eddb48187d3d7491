"""Order lines in USD, and the order-line fact."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.fixed_values import UNKNOWN_PRODUCT_ID
from starmart.functions.money import amount_usd
from starmart.operators.asof import join_nearest
from starmart.operators.colocated import Colocated
from starmart.operators.skew import HotKeys, join_spread
from starmart.plans.dimensions import current_products
from starmart.schemas import FACT_COLUMNS

LINE_KEY = ["order_item_id"]

USD_COLUMNS = (
    "order_item_id",
    "order_id",
    "product_id",
    "order_date",
    "quantity",
    "unit_price",
    "currency",
    "is_valid_currency",
    "line_amount_native",
    "rate_to_usd",
    "line_amount_usd",
    "is_fx_convertible",
    "_loaded_at",
)


def dated_lines(
    items: DataFrame, orders: DataFrame, how: str = "inner", hot: HotKeys | None = None
) -> DataFrame:
    """Lines with date and customer of their order; an order may own any share of them."""
    placed = orders.select("order_id", "order_date", "customer_id")
    return join_spread(items, placed, ["order_id"], how, LINE_KEY, hot_in=hot)


def order_items_usd(
    items: DataFrame, orders: DataFrame, rates: DataFrame, how: str = "left"
) -> DataFrame:
    """Lines with their USD amount; ``how="inner"`` drops lines without an order."""
    return _rated(dated_lines(items, orders, how), rates).select(*USD_COLUMNS)


def _rated(dated: DataFrame, rates: DataFrame) -> DataFrame:
    rated = join_nearest(
        dated,
        rates,
        key="currency",
        line_day=F.col("order_date").cast("date"),
        day="rate_date",
        value="rate_to_usd",
        spread_by=LINE_KEY,
    )
    return rated.withColumns(
        {
            "line_amount_usd": amount_usd(F.col("line_amount_native"), F.col("rate_to_usd")),
            "is_fx_convertible": F.col("rate_to_usd").isNotNull(),
        }
    )


def fact_order_items(
    items: DataFrame, orders: DataFrame, rates: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order line. For an incremental run pass the new lines only.

    The orders table is joined once, for the date and the customer together. Products
    outside the catalogue get the placeholder key and a flag. Hot orders and hot products
    are looked for in one pass over the lines.
    """
    hot = HotKeys(items, ["order_id"], ["product_id"])
    lines = _rated(dated_lines(items, orders, hot=hot), rates)
    return _with_known_products(lines, hot, products)


def fact_of_pair(pair: Colocated, rates: DataFrame, products: DataFrame) -> DataFrame:
    """The same from lines and orders that are kept side by side: no line is moved to its order."""
    dated = pair.joined("inner", ["order_date", "customer_id"])
    return _with_known_products(_rated(dated, rates), HotKeys(pair.lines(), ["product_id"]), products)


def _with_known_products(lines: DataFrame, hot: HotKeys, products: DataFrame) -> DataFrame:
    known = current_products(products).select("product_id").distinct()
    known = known.withColumn("_known", F.lit(True))
    joined = join_spread(lines, known, ["product_id"], "left", LINE_KEY, hot_in=hot)
    is_unknown = F.col("_known").isNull()
    return joined.withColumns(
        {
            "product_id": F.when(is_unknown, UNKNOWN_PRODUCT_ID).otherwise(F.col("product_id")),
            "order_date_day": F.col("order_date").cast("date"),
            "order_hour": F.hour("order_date").cast("long"),
            "is_unknown_product": is_unknown,
        }
    ).select(*FACT_COLUMNS)
