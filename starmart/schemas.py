"""Declared schemas. Readers never infer: money is decimal, time has no zone."""

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 6)
# quantity * price * rate keeps all 8 fractional digits within 38 digits
AMOUNT_USD = T.DecimalType(37, 8)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RAW_CUSTOMERS = _struct(
    ("id", T.LongType(), False),
    ("name", T.StringType(), False),
    ("email", T.StringType(), False),
    ("registration_date", T.TimestampNTZType(), False),
    ("country", T.StringType(), False),
)

RAW_ORDERS = _struct(
    ("id", T.LongType(), False),
    ("customer_id", T.LongType(), False),
    ("order_date", T.TimestampNTZType(), False),
    ("total_amount", PRICE, False),
    ("currency", T.StringType(), False),
    ("status", T.StringType(), False),
    ("_loaded_at", T.TimestampNTZType(), False),
)

RAW_ORDER_ITEMS = _struct(
    ("id", T.LongType(), False),
    ("order_id", T.LongType(), False),
    ("product_id", T.LongType(), False),
    ("quantity", T.IntegerType(), False),
    ("unit_price", PRICE, False),
    ("currency", T.StringType(), False),
    ("_loaded_at", T.TimestampNTZType(), False),
)

RAW_PRODUCTS = _struct(
    ("id", T.LongType(), False),
    ("name", T.StringType(), False),
    ("category", T.StringType(), False),
    ("description", T.StringType(), True),
    ("base_price", PRICE, False),
    ("currency", T.StringType(), False),
)

RAW_PRODUCT_HISTORY = T.StructType(
    RAW_PRODUCTS.fields
    + [
        T.StructField("valid_from", T.TimestampNTZType(), False),
        T.StructField("valid_to", T.TimestampNTZType(), False),
    ]
)

RAW_FX_RATES = _struct(
    ("base_currency", T.StringType(), False),
    ("quote_currency", T.StringType(), False),
    ("rate_date", T.DateType(), False),
    ("rate", RATE, False),
)

RAW_TABLES = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_products": RAW_PRODUCTS,
    "raw_fx_rates": RAW_FX_RATES,
}

FX_RESPONSES = _struct(
    (
        "responses",
        T.ArrayType(
            _struct(
                ("base", T.StringType(), True),
                ("date", T.DateType(), True),
                ("rates", T.MapType(T.StringType(), RATE), True),
            )
        ),
        True,
    ),
)

FACT_COLUMNS = (
    "order_item_id",
    "order_id",
    "customer_id",
    "product_id",
    "order_date",
    "order_date_day",
    "order_hour",
    "quantity",
    "unit_price",
    "currency",
    "is_valid_currency",
    "line_amount_native",
    "rate_to_usd",
    "line_amount_usd",
    "is_fx_convertible",
    "is_unknown_product",
    "_loaded_at",
)

PRODUCT_VERSION_COLUMNS = (
    "product_id",
    "product_name",
    "category",
    "description",
    "base_price",
    "currency",
    "valid_from",
    "valid_to",
)
