"""Cleaned views over the raw tables: rename, trim, normalise, flag."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.fixed_values import REPORTING_CURRENCY
from starmart.functions.cleaning import (
    clean_currency,
    clean_email,
    clean_text,
    is_known_currency,
)
from starmart.functions.money import line_amount


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("customer_id"),
        clean_text("name").alias("customer_name"),
        clean_email("email").alias("email"),
        "registration_date",
        clean_text("country").alias("country"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"),
        "customer_id",
        "order_date",
        "total_amount",
        clean_currency("currency").alias("currency"),
        is_known_currency(clean_currency("currency")).alias("is_valid_currency"),
        "status",
        "_loaded_at",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        clean_currency("currency").alias("currency"),
        is_known_currency(clean_currency("currency")).alias("is_valid_currency"),
        line_amount(F.col("quantity"), F.col("unit_price")).alias("line_amount_native"),
        "_loaded_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("product_id"),
        clean_text("name").alias("product_name"),
        clean_text("category").alias("category"),
        "description",
        "base_price",
        clean_currency("currency").alias("currency"),
    )


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    """Rates that convert straight into the reporting currency."""
    return raw.filter(clean_currency("quote_currency") == REPORTING_CURRENCY).select(
        clean_currency("base_currency").alias("currency"),
        "rate_date",
        F.col("rate").alias("rate_to_usd"),
    )
