"""Dimensions and calendar spines."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.fixed_values import (
    CALENDAR_FIRST_DAY,
    CALENDAR_LAST_DAY,
    UNKNOWN_PRODUCT_CATEGORY,
    UNKNOWN_PRODUCT_ID,
    UNKNOWN_PRODUCT_NAME,
)
from starmart.functions.calendar import calendar_columns, day_part, day_part_sort
from starmart.schemas import PRICE, PRODUCT_VERSION_COLUMNS


def dim_customers(staged: DataFrame) -> DataFrame:
    """Type 1: the latest extract replaces the table."""
    return staged.select("customer_id", "customer_name", "email", "registration_date", "country")


def dim_products(history: DataFrame) -> DataFrame:
    """Type 2: all versions, plus the placeholder for products outside the catalogue."""
    versions = history.select(
        *PRODUCT_VERSION_COLUMNS, F.col("valid_to").isNull().alias("is_current")
    )
    return versions.unionByName(_placeholder(history.sparkSession))


def _placeholder(spark: SparkSession) -> DataFrame:
    def missing(kind, name):
        return F.lit(None).cast(kind).alias(name)

    return spark.range(0, 1, 1, 1).select(
        F.lit(UNKNOWN_PRODUCT_ID).cast("long").alias("product_id"),
        F.lit(UNKNOWN_PRODUCT_NAME).alias("product_name"),
        F.lit(UNKNOWN_PRODUCT_CATEGORY).alias("category"),
        missing("string", "description"),
        missing(PRICE, "base_price"),
        missing("string", "currency"),
        missing("timestamp_ntz", "valid_from"),
        missing("timestamp_ntz", "valid_to"),
        F.lit(True).alias("is_current"),
    )


def current_products(products: DataFrame) -> DataFrame:
    """One row per product id, so a join never repeats a line for older versions."""
    return products.filter("is_current")


def dim_date(
    spark: SparkSession, first: date = CALENDAR_FIRST_DAY, last: date = CALENDAR_LAST_DAY
) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    spine = spark.range(0, 1, 1, 1).select(F.explode(days).alias("day"))
    return spine.select(*calendar_columns(F.col("day")))


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    hours = spark.range(0, 24, numPartitions=1)
    return hours.select(
        F.col("id").alias("hour_of_day"),
        day_part(F.col("id")).alias("day_part"),
        day_part_sort(F.col("id")).alias("day_part_sort"),
    )
