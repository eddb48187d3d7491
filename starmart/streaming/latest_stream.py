"""The newest row per key, kept as stream state."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starmart.operators.latest import latest_by_key


def start_latest(
    changes: DataFrame, key: str, order_by: list[str], load: Callable[[DataFrame], None], checkpoint: str
) -> StreamingQuery:
    """Process the changes that are new since the last run, then stop.

    The newest row of each key is the state of a streaming aggregation, so earlier changes are
    never read again, and a late change with an old stamp meets the state and loses. Each batch
    hands ``load`` the keys that it has touched, with their newest row; ``load`` must be
    repeatable, as ``upsert_partitions`` is.
    """
    newest = latest_by_key(changes, key, order_by)
    return (
        newest.writeStream.outputMode("update")
        .foreachBatch(lambda rows, _: load(rows))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
