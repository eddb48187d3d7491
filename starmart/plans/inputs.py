"""The given benchmark tables presented as the raw extracts of a shop.

They have no currencies, rates, load stamps or catalogue gaps, so those are derived
from keys and amounts, with padded, lower-case, unknown and missing codes among them.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.fixed_values import BATCH_1_LOADED_AT, BATCH_2_LOADED_AT
from starmart.functions.calendar import local_time
from starmart.schemas import PRICE, RATE
from starmart.storage import land

FIRST_EXTRACT_AT = datetime(2001, 1, 1)
SECOND_EXTRACT_AT = datetime(2001, 7, 1)
OPEN_END = datetime(9999, 12, 31)
OUTSIDE = 10_000_000_000  # added to an id, gives one that its parent table does not hold

TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns in use, with declared types (no inference pass over the files)."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _currency(order_key: str) -> Column:
    return F.expr(
        f"case {order_key} % 10 when 5 then ' eur ' when 6 then 'EUR' when 7 then 'GBP'"
        f" when 8 then 'XYZ' when 9 then null else 'USD' end"
    )


def _loaded_at(in_second: Column) -> Column:
    return F.when(in_second, local_time(BATCH_2_LOADED_AT)).otherwise(
        local_time(BATCH_1_LOADED_AT)
    )


def line_id(lines: DataFrame) -> Column:
    """A stable id from the columns that identify a line (60 bits of a digest, because
    the tables have no single-column key; a real extract brings its own)."""
    identity = F.concat_ws(
        "-",
        lines.l_orderkey,
        lines.l_linenumber,
        lines.l_partkey,
        lines.l_suppkey,
        lines.l_shipdate.cast("date"),
    )
    return F.conv(F.substring(F.md5(identity), 1, 15), 16, 10).cast("long")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey * 37 % 24 as int))").alias(
            "order_date"
        ),
        F.col("o_totalprice").cast(PRICE).alias("total_amount"),
        _currency("o_orderkey").alias("currency"),
        F.col("o_orderstatus").alias("status"),
        _loaded_at(F.col("o_orderkey") % 6 == 0).alias("_loaded_at"),
    )


def _sold_product() -> Column:
    """Lines of one part in twenty name a product that the first catalogue does not have."""
    key = F.col("l_partkey")
    return F.when(key % 20 == 0, key + OUTSIDE).otherwise(key)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        line_id(lines).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        _sold_product().alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("unit_price"),
        _currency("l_orderkey").alias("currency"),
        _loaded_at(F.col("l_orderkey") % 6 == 0).alias("_loaded_at"),
    )


def redelivered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second full extract: corrected lines come again, with the second stamp."""
    lines = table(spark, sf_dir, "lineitem")
    corrected = (F.col("l_orderkey") % 6 == 1) & (F.col("l_linenumber") == 1)
    return lines.select(
        line_id(lines).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        _sold_product().alias("product_id"),
        (F.col("l_quantity") + F.when(corrected, 1).otherwise(0)).cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("unit_price"),
        F.when(corrected, "XYZ").otherwise(_currency("l_orderkey")).alias("currency"),
        _loaded_at((F.col("l_orderkey") % 6 == 0) | corrected).alias("_loaded_at"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    customers = table(spark, sf_dir, "customer")
    known = customers.c_nationkey == nations.n_nationkey
    return customers.join(nations, known, "left").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        F.concat(F.lit(" "), "c_name", F.lit("@Shop.Example ")).alias("email"),
        F.expr(
            "timestamp_ntz'1994-01-01 08:30:00' + make_dt_interval(cast(c_custkey % 365 as int))"
        ).alias("registration_date"),
        F.concat("n_name", F.lit(" ")).alias("country"),
    )


def _as_raw_product(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("  "), "p_name").alias("name"),
        F.concat("p_type", F.lit(" ")).alias("category"),
        F.col("p_brand").alias("description"),
        F.col("p_retailprice").cast(PRICE).alias("base_price"),
        F.lit(" usd ").alias("currency"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_raw_product(table(spark, sf_dir, "part"))


def second_raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later catalogue: some prices, categories and descriptions differ, some products
    are missing, some are new."""
    key = F.col("id")
    parts = _as_raw_product(table(spark, sf_dir, "part"))
    listed = parts.filter(key % 11 != 0)
    dearer = (F.col("base_price") * F.lit(1.1).cast("decimal(2,1)")).cast(PRICE)
    changed = listed.withColumns(
        {
            "base_price": F.when(key % 7 == 0, dearer).otherwise(F.col("base_price")),
            "category": F.when(key % 13 == 0, "MOVED").otherwise(F.col("category")),
            "description": F.when(key % 17 == 0, "reworded").otherwise(F.col("description")),
        }
    )
    ids = F.when(key % 40 == 0, F.array(key, key + OUTSIDE)).otherwise(F.array(key))
    return changed.withColumn("id", F.explode(ids))


def raw_product_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that versions itself: each year's highest sale price of a part is a
    version, valid until the part's next one. Landed once."""
    year = F.trunc(F.col("l_shipdate").cast("date"), "year").cast("timestamp_ntz")
    yearly = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", year.alias("valid_from"))
        .agg(F.max("l_extendedprice").cast(PRICE).alias("base_price"))
    )
    following = F.lead("valid_from").over(W.partitionBy("l_partkey").orderBy("valid_from"))
    versions = yearly.select(
        "l_partkey",
        "base_price",
        "valid_from",
        F.coalesce(following, local_time(OPEN_END)).alias("valid_to"),
    )
    parts = _as_raw_product(table(spark, sf_dir, "part")).drop("base_price")
    history = parts.join(versions, parts.id == versions.l_partkey).select(
        "id", "name", "category", "description", "base_price", "currency", "valid_from", "valid_to"
    )
    return land(history, "raw_product_history")


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates twice a month (GBP once), landed once.

    The moving part of a rate comes from the order total of the half month a year before, so
    the first year's orders are older than any rate. Some quotes are not in the reporting
    currency and codes are unclean.
    """
    day = F.col("o_orderdate").cast("date")
    half = F.date_add(F.trunc(day, "month"), F.when(F.dayofmonth(day) < 15, 0).otherwise(14))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(F.add_months(half, 12).alias("rate_date"))
        .agg((F.sum(cents) % 1000).cast(RATE).alias("x"))
    )
    step = F.lit("0.0001").cast("decimal(5,4)")

    def quote(base: str, quoted: str, start: str) -> Column:
        rate = F.lit(start).cast(RATE) + F.col("x") * step
        return F.struct(
            F.lit(base).alias("base_currency"),
            F.lit(quoted).alias("quote_currency"),
            "rate_date",
            rate.cast(RATE).alias("rate"),
        )

    one = F.struct(
        F.lit("USD").alias("base_currency"),
        F.lit("USD").alias("quote_currency"),
        "rate_date",
        F.lit("1").cast(RATE).alias("rate"),
    )
    gbp = F.when(F.dayofmonth("rate_date") == 1, quote("gbp ", " usd", "1.2"))
    quotes = F.array(one, quote(" Eur", "USD", "1.0"), gbp, quote("USD", "EUR", "0.9"))
    rates = daily.select(F.explode(quotes).alias("q")).filter(F.col("q").isNotNull())
    return land(rates.select("q.*"), "raw_fx_rates")


def raw_product_changes(lines: DataFrame) -> DataFrame:
    """Line items read as a change feed of part prices, extracted at each month's end."""
    return lines.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
        F.col("l_shipdate").alias("changed_at"),
        F.last_day("l_shipdate").alias("extracted_at"),
        line_id(lines).alias("change_id"),
    )
