"""Lines and their orders written side by side, so that joining them moves no line.

Both tables are bucketed by the order id and a part number with the same number of buckets; Spark
reads a bucket of either in one task and joins them there. The exchange is paid once, when a batch
is written, and not by every query. An order that would overfill a bucket is cut into parts
(``skew.find_hot_keys``); only such an order is repeated, once per part, so a line always finds it
beside itself, whatever share of the lines it owns.

The tables are files plus definitions: any session can open them by their folder. Every batch is a
partition of its own. Batches are named in ascending order, and only the newest can be written
again; it then replaces itself, so a batch that broke off is simply repeated. When an older order
becomes hot, the new batch carries the copies that its new parts need.

Order ids are unique over all batches. Rows without an order id stay, and join nothing. An order
may arrive after its lines.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.operators.skew import find_hot_keys
from starmart.storage import delete, file_system, path_exists

LINES, ORDERS, PARTS = "lines", "orders", "parts"
_PART, _BATCH = "_part", "_batch"
_PARTS = T.StructType([T.StructField("_hot", T.LongType()), T.StructField("_parts", T.IntegerType())])


@dataclass
class Colocated:
    """Two bucketed tables below ``path``. ``spread_by`` are columns that differ between the
    lines of one order; ``buckets`` should leave a bucket of lines within a task's memory."""

    spark: SparkSession
    path: str
    lines_schema: T.StructType
    orders_schema: T.StructType
    key: str
    spread_by: list[str]
    buckets: int

    def __post_init__(self):
        self._names = {}
        for name, schema in ((LINES, self.lines_schema), (ORDERS, self.orders_schema)):
            self._names[name] = self._define(name, schema)

    def _define(self, name: str, schema: T.StructType) -> str:
        table = f"colocated_{name}_{uuid4().hex}"
        files, folder = file_system(self.spark, f"{self.path}/{name}")
        files.mkdirs(folder)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"create table {table} ({columns}, {_PART} int, {_BATCH} string) using parquet"
            f" partitioned by ({_BATCH}) clustered by (`{self.key}`, {_PART})"
            f" into {self.buckets} buckets location '{self.path}/{name}'"
        )
        self.spark.catalog.recoverPartitions(table)
        return table

    def close(self) -> None:
        """Forget the definitions; the files stay."""
        for table in self._names.values():
            self.spark.sql(f"drop table if exists {table}")

    def batches(self) -> list[str]:
        """Names of the batches begun, oldest first; the last may have to be repeated."""
        if not path_exists(self.spark, f"{self.path}/{PARTS}"):
            return []
        files, folder = file_system(self.spark, f"{self.path}/{PARTS}")
        return sorted(s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory())

    def add(self, lines: DataFrame, orders: DataFrame, batch: str) -> None:
        """Append a batch, or replace the newest one if it has that name."""
        older = [b for b in self.batches() if b != batch]
        if older and older[-1] > batch:
            raise ValueError(f"batch {batch} would come before {older[-1]}")
        for table in (LINES, ORDERS):
            self._drop(table, batch)
        known = self._parts(older)
        hot = self.spark.createDataFrame([*find_hot_keys(lines, [self.key]).items()], _PARTS)
        # at most two rows per shuffle partition and batch
        hot.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{PARTS}/{batch}")
        parts = self._parts([*older, batch])
        salt = F.pmod(F.xxhash64(*self.spread_by), F.col("_parts")).cast("int")
        dealt = self._with_parts(lines, parts).withColumn(_PART, F.coalesce(salt, F.lit(0)))
        first, last = F.lit(0), F.coalesce("_parts", F.lit(1)) - 1
        copies = self._with_parts(orders, parts).withColumn(_PART, F.explode(F.sequence(first, last)))
        grown = parts.join(known.withColumnRenamed("_parts", "_had"), "_hot", "left")
        grown = grown.withColumn("_had", F.coalesce("_had", F.lit(1))).filter("_parts > _had")
        held = self.spark.table(self._names[ORDERS]).filter(F.col(_PART) == 0).drop(_PART, _BATCH)
        more = held.withColumn("_hot", F.xxhash64(self.key)).join(F.broadcast(grown), "_hot")
        more = more.withColumn(_PART, F.explode(F.sequence(F.col("_had"), F.col("_parts") - 1)))
        columns = [*self.orders_schema.names, _PART]
        self._append(ORDERS, copies.select(*columns).unionByName(more.select(*columns)), batch)
        self._append(LINES, dealt, batch)

    def _parts(self, batches: list[str]) -> DataFrame:
        """The most parts that any of the batches asks for, per hot key."""
        if not batches:
            return self.spark.createDataFrame([], _PARTS)
        noted = self.spark.read.schema(_PARTS).parquet(*[f"{self.path}/{PARTS}/{b}" for b in batches])
        return noted.groupBy("_hot").agg(F.max("_parts").alias("_parts"))

    def _with_parts(self, df: DataFrame, parts: DataFrame) -> DataFrame:
        # no id means no order: such lines are dealt by their own columns below
        return df.withColumn("_hot", F.xxhash64(self.key)).join(F.broadcast(parts), "_hot", "left")

    def _drop(self, table: str, batch: str) -> None:
        self.spark.sql(f"alter table {self._names[table]} drop if exists partition ({_BATCH} = '{batch}')")
        delete(self.spark, f"{self.path}/{table}/{_BATCH}={batch}")

    def _append(self, table: str, df: DataFrame, batch: str) -> None:
        schema = self.lines_schema if table == LINES else self.orders_schema
        rows = df.select(*schema.names, _PART, F.lit(batch).alias(_BATCH))
        # one file per bucket: the exchange deals rows as the buckets do
        rows.repartition(self.buckets, self.key, _PART).write.insertInto(self._names[table])

    def lines(self) -> DataFrame:
        return self.spark.table(self._names[LINES]).select(*self.lines_schema.names)

    def joined(self, how: str, columns: list[str]) -> DataFrame:
        """Lines with ``columns`` of their order, without an exchange of either."""
        lines = self.spark.table(self._names[LINES]).drop(_BATCH)
        orders = self.spark.table(self._names[ORDERS]).select(self.key, _PART, *columns)
        # told to be a merge, because a broadcast of all orders must not be tried
        return lines.join(orders.hint("merge"), [self.key, _PART], how).select(
            *self.lines_schema.names, *columns
        )
