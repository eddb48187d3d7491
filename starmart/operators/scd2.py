"""Type-2 history: change detection, native history, and point-in-time lookup."""

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.calendar import local_time
from starmart.operators.skew import join_spread

# A difference in one of these opens a new product version.
CHECKED_COLUMNS = ("product_name", "category", "base_price", "currency")


def first_snapshot(extract: DataFrame, run_at: datetime) -> DataFrame:
    return _opened(extract, run_at)


def snapshot(
    history: DataFrame,
    extract: DataFrame,
    run_at: datetime,
    key: str = "product_id",
    checked: tuple[str, ...] = CHECKED_COLUMNS,
) -> DataFrame:
    """History after one more extract, taken at ``run_at``.

    A changed row closes its open version and opens a new one; a new key opens its first;
    a key missing from the extract stays open. One full outer join; a row yields the kept
    or closed old version and, if needed, the opened one.
    """
    columns = history.columns
    is_open = F.col("valid_to").isNull()
    change = compared(history.filter(is_open), _opened(extract, run_at).select(*columns), key, checked)
    closed = F.col("old").withField("valid_to", local_time(run_at))
    kept = F.when(F.col("closes"), closed).otherwise(F.col("old"))
    opened = F.when(F.col("opens"), F.col("new"))
    versions = (
        change.select(F.explode(F.array(kept, opened)).alias("version"))
        .filter(F.col("version").isNotNull())
        .select("version.*")
    )
    return history.filter(~is_open).unionByName(versions)


def compared(open_versions: DataFrame, extract: DataFrame, key: str, checked: tuple[str, ...]) -> DataFrame:
    """One row per key: the open version ``old``, the extracted row ``new``, and whether the
    one ``closes`` and the other ``opens``."""
    old = open_versions.select(key, F.struct(*open_versions.columns).alias("old"))
    new = extract.select(key, F.struct(*extract.columns).alias("new"))
    differs = reduce(
        lambda any_, c: any_ | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")),
        checked,
        F.lit(False),
    )
    known, seen = F.col("old").isNotNull(), F.col("new").isNotNull()
    return old.join(new, key, "full_outer").select(
        "old", "new", (known & seen & differs).alias("closes"), (seen & (~known | differs)).alias("opens")
    )


def from_native_history(staged: DataFrame, open_end: datetime) -> DataFrame:
    """Use the source's own validity; its open-end marker becomes NULL."""
    marker = local_time(open_end)
    return staged.withColumn(
        "valid_to", F.when(F.col("valid_to") < marker, F.col("valid_to"))
    )


def join_valid_at(
    lines: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    attributes: dict[str, str],
    spread_by: list[str],
    grain: str = "month",
    dates_in: DataFrame | None = None,
) -> DataFrame:
    """Add the attributes of the version valid at ``at`` (``valid_from <= at < valid_to``).

    Lines and versions meet on key and period, not on key alone, so a line is compared
    only with the versions of its own month; a finer ``grain`` suits keys that change
    many times a month. Versions of one key do not overlap, so a line matches at most
    once. Lines without a version get NULLs. ``dates_in`` is a cheaper frame that covers
    the dates of the lines, if those come from a join.
    """
    span = (lines if dates_in is None else dates_in).agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    first, last = local_time(span.first), local_time(span.last)
    start = F.greatest("valid_from", first)
    stop = F.least("valid_to", last)
    step = F.expr(f"interval 1 {grain}")
    periods = F.sequence(_period(start, grain), _period(stop, grain), step)
    by_period = versions.filter(start <= stop).select(
        key,
        F.explode(periods).alias("_period"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(column).alias(name) for name, column in attributes.items()],
    )
    dated = lines.withColumn("_period", _period(F.col(at), grain))
    is_valid = (F.col("_from") <= F.col(at)) & (
        F.col("_to").isNull() | (F.col(at) < F.col("_to"))
    )
    joined = join_spread(
        dated, by_period, [key, "_period"], "left", spread_by, residual=is_valid
    )
    return joined.select(*lines.columns, *attributes)


def _period(at: Column, grain: str) -> Column:
    day = at.cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def _opened(extract: DataFrame, run_at: datetime) -> DataFrame:
    return extract.withColumns(
        {
            "valid_from": local_time(run_at),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
        }
    )
