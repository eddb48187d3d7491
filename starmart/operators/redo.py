"""What late reference data changes, and only that.

A rate that arrives late changes the nearest rate of some days. The difference of the rate
intervals before and after says which days of which currency; only the lines of these days are
read again, and of these only the ones whose rate is another now are written. A product that
enters the catalogue late changes the lines that named it, which the fact holds under the
placeholder; they are found in the staged lines.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart import published
from starmart.functions.money import amount_usd
from starmart.operators.asof import VALUE_BYTES, validity_intervals
from starmart.operators.skew import BROADCAST_BYTES, ROW_OVERHEAD_BYTES, broadcast_if_small, join_spread
from starmart.plans.dimensions import current_products


def changed_intervals(before: DataFrame, after: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """(key, valid_from, valid_to, value): days for which ``after`` gives another value.

    An end is NULL where the interval is open, the value NULL where none is left. Rows follow the
    rates, and a window holds one key's dated values, which the calendar bounds.
    """
    sides = {
        name: validity_intervals(rates, key, day, value).select(key, "valid_from", F.struct(value).alias(name))
        for name, rates in (("old", before), ("new", after))
    }
    starts = (
        sides["old"]
        .unionByName(sides["new"], allowMissingColumns=True)
        .groupBy(key, "valid_from")
        .agg(F.first("old", ignorenulls=True).alias("old"), F.first("new", ignorenulls=True).alias("new"))
    )
    in_order = W.partitionBy(key).orderBy(F.col("valid_from").asc_nulls_first())
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    segments = starts.select(
        key,
        "valid_from",
        F.lead("valid_from").over(in_order).alias("valid_to"),
        F.last("old", ignorenulls=True).over(so_far)[value].alias("was"),
        F.last("new", ignorenulls=True).over(so_far)[value].alias(value),
    )
    return segments.filter(~F.col("was").eqNullSafe(F.col(value))).drop("was")


def changed_calendar(changed: DataFrame, key: str, value: str, first, last) -> DataFrame:
    """One row per key and changed day between two days, both included."""
    start = F.greatest(F.coalesce("valid_from", F.lit(first)), F.lit(first))
    stop = F.least(F.coalesce(F.date_sub("valid_to", 1), F.lit(last)), F.lit(last))
    days = F.explode(F.sequence(start, stop)).alias("_day")
    return changed.filter(start <= stop).select(key, days, F.col(value).alias("_new"))


def rerated(lines: DataFrame, calendar: DataFrame, spread_by: list[str]) -> DataFrame:
    """Fact lines whose rate has changed, with their new rate and amount."""
    size = calendar.agg(F.count(F.lit(1)).alias("rows"), F.max(F.octet_length("currency")).alias("key_bytes")).first()
    keys = ["currency", "_day"]
    dated = lines.withColumn("_day", F.col("order_date_day"))
    if size.rows * (ROW_OVERHEAD_BYTES + VALUE_BYTES + (size.key_bytes or 0)) <= BROADCAST_BYTES:
        joined = dated.join(F.broadcast(calendar), keys)
    else:
        joined = join_spread(dated, calendar, keys, "inner", spread_by)
    now: dict[str, Column] = {
        "rate_to_usd": F.col("_new").cast(lines.schema["rate_to_usd"].dataType),
        "line_amount_usd": amount_usd(F.col("line_amount_native"), F.col("_new")).cast(lines.schema["line_amount_usd"].dataType),
        "is_fx_convertible": F.col("_new").isNotNull(),
    }
    return joined.filter(~F.col("rate_to_usd").eqNullSafe(F.col("_new"))).select(
        *[now.get(c, F.col(c)).alias(c) for c in lines.columns]
    )


def lines_to_rerate(
    path: str,
    schema,
    before: DataFrame,
    after: DataFrame,
    partition_by: str = "order_date_day",
    partition_of: Column | None = None,
    spread_by: tuple[str, ...] = ("order_item_id",),
) -> DataFrame | None:
    """Lines of a published fact that other rates change; None if there are none to look at.

    Only the partitions of changed days are opened. ``partition_of`` gives a day's partition.
    """
    spark = before.sparkSession
    now = published.manifest(spark, path)
    changed = changed_intervals(before, after, "currency", "rate_date", "rate_to_usd")
    days = published.read(spark, path, schema, now).agg(F.min("order_date_day"), F.max("order_date_day")).first()
    if days[0] is None:
        return None
    calendar = changed_calendar(changed, "currency", "rate_to_usd", *days)
    part = F.col("_day") if partition_of is None else partition_of
    touched = calendar.select(part.cast("string")).distinct().collect()  # one row per calendar period
    names = {published.partition_name(spark, partition_by, r[0]) for r in touched}
    opened = now.only(names)
    if not opened.folders:
        return None
    return rerated(published.read(spark, path, schema, opened), calendar, list(spread_by))


def lines_of_new_products(items: DataFrame, before: DataFrame, after: DataFrame, spread_by: tuple[str, ...] = ("order_item_id",)) -> DataFrame:
    """Staged lines whose product ``after`` has as current and ``before`` had not, and the reverse."""
    was, now = (current_products(p).select("product_id").distinct() for p in (before, after))
    moved = now.join(was, "product_id", "left_anti").unionByName(was.join(now, "product_id", "left_anti"))
    return join_spread(items, broadcast_if_small(moved), ["product_id"], "left_semi", list(spread_by))
