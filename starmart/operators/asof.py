"""Nearest-date join: the latest value on or before a day, else the earliest later one.

Work per line must not grow with the length of the rate history. So the history is
turned into a calendar with one row per key and day, and lines find their rate with a
plain equality join: no candidate fan-out, no window over lines.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.operators.skew import BROADCAST_BYTES, ROW_OVERHEAD_BYTES, join_spread

VALUE_BYTES = 32


def one_value_per_day(history: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Unique (key, day); of several values for one day the smallest is kept, so the
    result does not depend on row order."""
    return (
        history.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
        .groupBy(key, day)
        .agg(F.min(value).alias(value))
    )


def validity_intervals(history: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """[valid_from, valid_to) per value; NULL means open.

    The first interval of a key is open to the past, which is the fall-back to a later
    value; the last one is open to the future. A window holds one key's dated values,
    which the calendar bounds.
    """
    by_day = W.partitionBy(key).orderBy(day)
    is_first = F.row_number().over(by_day) == 1
    return one_value_per_day(history, key, day, value).select(
        key,
        value,
        F.when(~is_first, F.col(day)).alias("valid_from"),
        F.lead(day).over(by_day).alias("valid_to"),
    )


def daily_calendar(intervals: DataFrame, key: str, value: str, first, last) -> DataFrame:
    """One row per key and day between two days, both included."""
    start = F.coalesce("valid_from", F.lit(first))
    stop = F.coalesce(F.date_sub("valid_to", 1), F.lit(last))
    return intervals.filter(start <= stop).select(
        key, F.explode(F.sequence(start, stop)).alias("_day"), value
    )


def join_nearest(
    lines: DataFrame,
    history: DataFrame,
    key: str,
    line_day: Column,
    day: str,
    value: str,
    spread_by: list[str],
) -> DataFrame:
    """Add ``value`` to every line; NULL where the key has no history or no day.

    Days outside the history are clamped to its first or last day, so the calendar
    spans the history only and its size is known before it is built.
    """
    usable = history.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    span = usable.agg(
        F.min(day).alias("first"),
        F.max(day).alias("last"),
        F.count_distinct(key).alias("keys"),
        F.max(F.octet_length(key)).alias("key_bytes"),
    ).first()
    if span.first is None:
        return lines.withColumn(value, F.lit(None).cast(history.schema[value].dataType))
    intervals = validity_intervals(usable, key, day, value)
    calendar = daily_calendar(intervals, key, value, span.first, span.last)
    clamped = F.greatest(F.least(line_day, F.lit(span.last)), F.lit(span.first))
    dated = lines.withColumn("_day", F.when(line_day.isNotNull(), clamped))
    rows = span.keys * ((span.last - span.first).days + 1)
    if rows * (ROW_OVERHEAD_BYTES + VALUE_BYTES + span.key_bytes) <= BROADCAST_BYTES:
        joined = dated.join(F.broadcast(calendar), [key, "_day"], "left")
    else:
        joined = join_spread(dated, calendar, [key, "_day"], "left", spread_by)
    return joined.select(*lines.columns, value)


def rank_nearest(
    needed: DataFrame, history: DataFrame, key: str, needed_day: str, day: str, value: str
) -> DataFrame:
    """The same choice made by explicit ranking, for each distinct (key, day) needed.

    Each day meets two candidates, its nearest past and nearest later value, found by
    one sorted pass over days and values together; ``row_number`` then prefers the past
    and the shorter distance. Rows per window are bounded by the calendar.
    """
    entry = F.struct(F.col(day).alias("day"), F.col(value).alias("value"))
    dated = one_value_per_day(history, key, day, value).select(
        key, F.col(day).alias("_on"), F.lit(0).alias("_kind"), entry.alias("_entry")
    )
    days = (
        needed.select(key, F.col(needed_day).alias("_on"))
        .filter(F.col(key).isNotNull() & F.col("_on").isNotNull())
        .distinct()
        .select(key, "_on", F.lit(1).alias("_kind"), F.lit(None).cast(_entry_type(dated)).alias("_entry"))
    )
    timeline = W.partitionBy(key).orderBy("_on", "_kind")
    past = F.last("_entry", ignorenulls=True).over(
        timeline.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    later = F.first("_entry", ignorenulls=True).over(
        timeline.rowsBetween(W.currentRow, W.unboundedFollowing)
    )
    candidates = (
        dated.unionByName(days)
        .select(key, "_on", "_kind", past.alias("past"), later.alias("later"))
        .filter(F.col("_kind") == 1)
        .select(key, "_on", F.explode(F.array("past", "later")).alias("c"))
        .filter(F.col("c").isNotNull())
        .select(
            key,
            F.col("_on").alias(needed_day),
            F.col("c.value").alias(value),
            F.when(F.col("c.day") <= F.col("_on"), 0).otherwise(1).alias("is_future"),
            F.abs(F.datediff("_on", "c.day")).alias("days_apart"),
        )
    )
    best_first = W.partitionBy(key, needed_day).orderBy("is_future", "days_apart", value)
    return (
        candidates.withColumn("_rank", F.row_number().over(best_first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def _entry_type(df: DataFrame):
    return df.schema["_entry"].dataType
