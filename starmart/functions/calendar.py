"""Calendar and time-of-day attributes."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.fixed_values import DAY_PARTS


def local_time(value: datetime | None) -> Column:
    """A time without zone as a literal. A plain ``lit`` of a Python time would have a
    zone, and shift with the session's."""
    text = None if value is None else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def calendar_columns(day: Column) -> list[Column]:
    sunday_is_0 = F.dayofweek(day) - 1
    return [
        day.alias("date_day"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("long").alias("day_of_month"),
        sunday_is_0.cast("long").alias("day_of_week_num"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        sunday_is_0.isin(0, 6).alias("is_weekend"),
    ]


def day_part(hour: Column) -> Column:
    return _by_day_part(hour, [label for _, _, label in DAY_PARTS])


def day_part_sort(hour: Column) -> Column:
    return _by_day_part(hour, range(1, len(DAY_PARTS) + 1)).cast("long")


def _by_day_part(hour: Column, values) -> Column:
    *others, last = zip(DAY_PARTS, values)
    cases = reduce(
        lambda chain, case: chain.when(hour.between(case[0][0], case[0][1]), case[1]), others, F
    )
    return cases.otherwise(last[1])
