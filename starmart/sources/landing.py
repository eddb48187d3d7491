"""Load stamps and batch split of landed extracts."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.fixed_values import BATCH_1_LOADED_AT, BATCH_2_LOADED_AT
from starmart.functions.calendar import local_time
from starmart.operators.skew import join_spread


def stamp_loaded_at(
    df: DataFrame,
    order_id: str,
    cutoff: int,
    first: datetime = BATCH_1_LOADED_AT,
    second: datetime = BATCH_2_LOADED_AT,
) -> DataFrame:
    """Add ``_loaded_at``. Both times are inputs: a rerun must stamp the same."""
    stamp = F.when(F.col(order_id) <= cutoff, local_time(first)).otherwise(local_time(second))
    return df.withColumn("_loaded_at", stamp)


def first_batch(orders: DataFrame, items: DataFrame, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Orders up to the cutoff, and the lines that belong to one of them."""
    early = orders.filter(F.col("id") <= cutoff)
    keys = early.select(F.col("id").alias("order_id"))
    # the same bound on the line side is implied by the join; stating it lets the
    # line scan skip row groups before the shuffle
    lines = items.filter(F.col("order_id") <= cutoff)
    lines = join_spread(lines, keys, ["order_id"], "left_semi", ["id"])
    return early, lines.select(*items.columns)
