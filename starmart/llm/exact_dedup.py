"""Exact deduplication against a persistent index of digests.

The index is a table of one row per distinct text, bucketed and sorted by digest, in one
partition per batch. A batch is reduced to one row per digest before any join; the anti-join with
the other batches of the index is a sort-merge join that reads the buckets as they lie: nothing of
the index is shuffled. A bucket of several batches is several sorted files, so Spark still sorts
them within the task. Only unseen digests are written. What is in the index stays: a later copy
never replaces an indexed document.

A batch has a name. Adding it again compares it with the other batches only and writes the same
rows in the same place, so a run that died at any step can be repeated, before or after its
documents were used.

Defined results
    null text               counts as empty, and equals other empty texts
    very long text          hashed whole
    ties, repeated rows     of equal texts in a batch the largest doc_id stays (a null id
                            is smaller than any other), of equal ids the last by file and place
    empty table             empty result, nothing is added
    clashing extra columns  only the id and the text are read
"""

import re
from functools import reduce
from hashlib import sha1
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import ROW_ID, identified, land, partitions, text_or_empty
from starmart.storage import new_path, path_exists

SCHEMA = "digest binary, keep_id bigint, batch string"
BATCHES = 3

_NO_ID = -(1 << 63) + 1  # order of a null id
_ROWS = 1 << 63  # row numbers are below


class DigestIndex:
    """A bucketed, sorted table of digests below ``path``.

    The files are what persists; a session that knows nothing of them registers them again.
    ``buckets`` is fixed when the index is made.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{sha1(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({SCHEMA}) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if path_exists(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def write(self, batch: str, digests: DataFrame) -> None:
        """Make these the digests of the batch, in place of what it had."""
        view = f"digests_{uuid4().hex}"
        sorted_rows = digests.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        sorted_rows.select("digest", "keep_id").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = '{batch}') SELECT digest, keep_id FROM {view}")
        self.spark.catalog.dropTempView(view)

    def add_batch(self, docs: DataFrame, batch: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
        """Deduplicate a batch against the others of the index and write what is new.

        Returns one row per document: row id, id, digest, ``keep_id``, ``group_size`` (rows
        of the batch with this text) and ``kept``.
        """
        return _decided(*self._add(identified(docs), batch, id_column, text))

    def _add(self, docs: DataFrame, batch: str, id_column: str, text: str) -> tuple[DataFrame, DataFrame]:
        """(rows with their digest, what holds for each digest), both written."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"batch name {batch!r}")
        rows = land(
            docs.select(
                ROW_ID,
                F.col(id_column).cast("long").alias("doc_id"),
                F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256)).alias("digest"),
            ),
            "digests",
        )
        # id and row in one number: fixed width, so the grouping is a hash table and no sort
        order = F.expr(f"cast(cast(coalesce(doc_id, {_NO_ID}) as decimal(19,0)) * {_ROWS} + {ROW_ID} as decimal(38,0))")
        last = rows.groupBy("digest").agg(F.max(order).alias("last"), F.count(F.lit(1)).alias("group_size"))
        keep_row = F.expr(f"cast(pmod(last, {_ROWS}) as bigint)")
        largest = F.expr(f"(last - keep_row) div {_ROWS}")
        keep_id = F.when(largest != F.lit(_NO_ID), largest)
        groups = land(last.withColumn("keep_row", keep_row).select("digest", keep_id.alias("keep_id"), "keep_row", "group_size"), "batch")
        # the index is as large as all texts ever seen: merge, never build a hash table of it
        others = self.read().filter(F.col("batch") != batch).hint("merge")
        fresh = land(groups.join(others, "digest", "left_anti"), "fresh")
        old = groups.join(others.select("digest", F.col("keep_id").alias("old_id")), "digest")
        known = old.select("digest", F.col("old_id").alias("keep_id"), F.lit(-1).cast("long").alias("keep_row"), "group_size")
        winners = land(fresh.unionByName(known), "winners")
        self.write(batch, fresh)
        return rows, winners


def _decided(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Both sides are read from files, so a digest with a third of the rows is split by AQE."""
    return rows.join(winners, "digest").select(
        ROW_ID, "doc_id", "digest", "keep_id", "group_size", (F.col(ROW_ID) == F.col("keep_row")).alias("kept")
    )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as shuffle partitions."""
    return DigestIndex(spark, new_path(spark, "digest-index"), partitions(spark))


def deduplicate(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """A whole table against an index, the largest ids first, in batches of about equal size.

    So of equal texts the largest id is indexed, and each later batch is decided by what the index
    holds. Returns the rows of ``add_batch``; ``group_size`` counts the whole table.
    """
    return _deduplicate(identified(docs), index, id_column, text, batches)


def _deduplicate(docs: DataFrame, index: DigestIndex, id_column: str, text: str, batches: int) -> DataFrame:
    key = F.col(id_column).cast("long")
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.select(key.alias("k")).approxQuantile("k", shares, 0.01) if shares else []
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    ranges = [key >= cut for cut in cuts] + [F.lit(True)]
    found, above = [], None
    for i, from_cut in enumerate(ranges):
        mine = from_cut if above is None else from_cut & ~F.coalesce(above, F.lit(False))
        found.append(index._add(docs.filter(mine), f"{i:04d}", id_column, text))
        above = from_cut
    # one row per digest and batch: a digest with a third of the documents is a few rows here
    sizes = reduce(DataFrame.unionByName, [winners.select("digest", "group_size") for _, winners in found])
    sizes = land(sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size")), "sizes")
    whole = [(rows, land(winners.drop("group_size").join(sizes, "digest"), "winners")) for rows, winners in found]
    return reduce(DataFrame.unionByName, [_decided(*parts) for parts in whole])


def drop_copies(docs: DataFrame, index: DigestIndex, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of a table whose text is new, one for each text, with their own columns.

    Dropped rows are joined, not kept ones: they are the smaller side, so texts are shuffled
    only where that side is too large for a broadcast.
    """
    numbered = identified(docs)
    dropped = _deduplicate(numbered, index, id_column, text, BATCHES).filter("not kept").select(ROW_ID)
    return numbered.join(land(dropped, "dropped"), ROW_ID, "left_anti").select(*docs.columns)
