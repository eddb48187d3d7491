"""Continuous form of the nightly fact load."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart import published
from starmart.operators.latest import latest_by_key
from starmart.operators.skew import broadcast_if_small
from starmart.operators.staging import stg_order_items, stg_orders
from starmart.plans.fact import fact_order_items
from starmart.storage import landed

WAITING_BUCKETS = 256
_BATCH = "batch"  # the manifest's note of the batch that published it


def start_fact_upserts(
    raw_items: DataFrame,
    orders: DataFrame,
    rates: DataFrame,
    products: DataFrame,
    load: Callable[[DataFrame], None],
    checkpoint: str,
    raw_orders: DataFrame | None = None,
    waiting_buckets: int = WAITING_BUCKETS,
) -> StreamingQuery:
    """Process everything that has landed, then stop.

    The source offsets in the checkpoint take the place of the load mark, so lines that
    arrive late with an old stamp are not missed. ``load`` writes one delta, normally with
    ``upsert_partitions``, where the newest stamp wins.

    Lines whose order has not landed wait in a published table beside the checkpoint, in
    buckets of their order id. ``raw_orders`` is the stream of landing orders: a batch of it,
    with or without lines, opens the buckets of its orders and releases their lines; other
    buckets are not read. ``orders`` holds what has landed before. Without that stream all
    waiting lines are tried with every batch of lines.
    """
    waiting = Waiting(raw_items.sparkSession, f"{checkpoint.rstrip('/')}-waiting", waiting_buckets)
    tagged = raw_items.select(F.struct(*raw_items.columns).alias("line"))
    if raw_orders is not None:
        tagged = tagged.unionByName(
            raw_orders.select(F.struct(*raw_orders.columns).alias("order")), allowMissingColumns=True
        )

    def upsert(batch: DataFrame, batch_id: int) -> None:
        lines = stg_order_items(batch.filter("line is not null").select("line.*"))
        known, arrived = orders, None
        if raw_orders is not None:
            arrived = stg_orders(batch.filter("order is not null").select("order.*"))
            known = orders.unionByName(arrived).dropDuplicates(["order_id"])
        before = waiting.before(lines.schema, batch_id)
        released = before.of_orders(arrived) if arrived is not None else before.all()
        others = [c for c in lines.columns if c not in ("order_item_id", "_loaded_at")]
        newest = latest_by_key(lines.unionByName(released), "order_item_id", ["_loaded_at", *others])
        with landed(newest, "lines") as newest, landed(known.select(*orders.columns), "orders") as known:
            early = newest.join(known.select("order_id"), "order_id", "left_anti").select(*newest.columns)
            before.replace(arrived, early)
            load(fact_order_items(newest, known, rates, products))

    return (
        tagged.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class Waiting:
    """Lines that wait for their order, in buckets of the order id."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = WAITING_BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def before(self, schema, batch_id: int) -> "WaitingBefore":
        """The lines as they waited before a batch, also if the batch has been here already."""
        for version in reversed(published.versions(self.spark, self.path)):
            at = published.manifest(self.spark, self.path, version)
            if int(at.notes[_BATCH]) < batch_id:
                return WaitingBefore(self, schema, at, batch_id)
        return WaitingBefore(self, schema, published.EMPTY, batch_id)


class WaitingBefore:
    def __init__(self, waiting: Waiting, schema, at: published.Manifest, batch_id: int):
        self.waiting, self.schema, self.at, self.batch_id = waiting, schema, at, batch_id

    def _read(self, at: published.Manifest) -> DataFrame:
        return published.read(self.waiting.spark, self.waiting.path, self.schema, at)

    def _names(self, rows: DataFrame) -> set[str]:
        found = rows.select(self.waiting.bucket()).distinct().collect()  # at most all buckets
        return {f"bucket={r.bucket}" for r in found}

    def all(self) -> DataFrame:
        return self._read(self.at)

    def of_orders(self, arrived: DataFrame) -> DataFrame:
        """Waiting lines of these orders; only the buckets of the orders are opened."""
        ids = broadcast_if_small(arrived.select("order_id").distinct())
        return self._read(self.at.only(self._names(arrived))).join(ids, "order_id", "left_semi").select(*self.schema.names)

    def replace(self, arrived: DataFrame | None, early: DataFrame) -> None:
        """Publish what waits after the batch: its early lines, and those not released."""
        spark, path, load = self.waiting.spark, self.waiting.path, published.new_load()
        touched, rows = self._names(early), early
        if arrived is None:
            touched |= set(self.at.folders)
        else:
            touched |= self._names(arrived) & set(self.at.folders)
            held = self._read(self.at.only(touched))
            ids = broadcast_if_small(arrived.select("order_id").distinct())
            rows = early.unionByName(held.join(ids, "order_id", "left_anti").select(*early.columns))
        if touched:
            bucketed = rows.select("*", self.waiting.bucket())
            bucketed.repartition("bucket").write.partitionBy("bucket").parquet(published.load_path(path, load))
        now = published.manifest(spark, path)
        after = published.Manifest(now.version, self.at.folders, self.at.notes)
        published.publish(spark, path, after, touched, load, {_BATCH: str(self.batch_id)})
