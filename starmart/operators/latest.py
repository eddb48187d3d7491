"""Latest row per key from an append-only change log."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(changes: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Keep the last change of each key; ``order_by`` must be unique within a key.

    An aggregate rather than a window: each task keeps one row per key before the
    shuffle, so a key with most of the changes sends one row per task.
    """
    payload = [c for c in changes.columns if c != key]
    order = F.struct(*order_by)
    # if every column takes part in the order, the greatest is the row, and moves once
    newest = F.max(order) if set(payload) <= set(order_by) else F.max_by(F.struct(*payload), order)
    return (
        changes.groupBy(key)
        .agg(newest.alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in payload])
    )
