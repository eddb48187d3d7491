"""Joins that hold up when one key owns a large share of the left rows."""

from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_LIMIT = 1_000_000  # most keys that Spark's sketch can track
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32

_FIXED_WIDTHS = {"boolean": 1, "int": 4, "date": 4, "bigint": 8, "timestamp_ntz": 8, "decimal": 16}


class HotKeys:
    """Keys of a frame that would overfill a shuffle partition, for all joins to come.

    One pass over all key columns, made when the first join needs it (never, if all other
    sides are broadcast), with a bounded sketch per key, merged map-side. A key counts
    as hot from half an average partition on, so there are at most two per partition; it gets as
    many parts as it has halves, so all parts together are at most four per partition, however
    many keys are hot. The sketch tracks ten times as many keys. It only steers the layout; the
    joins are exact whatever it returns.
    """

    def __init__(self, df: DataFrame, *keys: list[str]):
        self.df, self.keys = df, keys

    def of(self, keys: list[str]) -> dict[int, int]:
        """Hashes of the hot keys over these columns, each with its number of parts."""
        return self._found[self.keys.index(keys)]

    @cached_property
    def _found(self) -> list[dict[int, int]]:
        partitions = int(self.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = 0.5 / partitions
        tracked = min(max(10_000, 20 * partitions), SKETCH_LIMIT)
        most = min(2 * partitions, tracked)
        places = range(len(self.keys))
        hashes = [F.xxhash64(*keys).alias(f"key{i}") for i, keys in enumerate(self.keys)]
        sketches = [F.expr(f"approx_top_k(key{i}, {most}, {tracked})").alias(f"top{i}") for i in places]
        row = self.df.select(*hashes).agg(F.count(F.lit(1)).alias("rows"), *sketches).first()
        least = share * row.rows
        return [
            {k["item"]: -int(-k["count"] // least) for k in row[f"top{i}"] or [] if k["count"] > least}
            for i in places
        ]


def find_hot_keys(df: DataFrame, keys: list[str]) -> dict[int, int]:
    return HotKeys(df, keys).of(keys)


def is_small(df: DataFrame) -> bool:
    """Whether the row count proves the table fit for a broadcast.

    Only for fixed-width columns, where rows times width bounds the size. Anything else
    is left to the optimizer's own size statistics.
    """
    return fits_broadcast(df) is True


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """A broadcast if the row count proves the table small, a shuffle if it proves the opposite:
    the optimizer's statistics do not count the rows that an ``explode`` adds."""
    fits = fits_broadcast(df)
    if fits is None:
        return df
    return F.broadcast(df) if fits else df.hint("merge")


def fits_broadcast(df: DataFrame) -> bool | None:
    """Whether the row count, times the column widths, proves the table small; None if a width is open."""
    widths = [_FIXED_WIDTHS.get(kind.split("(")[0]) for _, kind in df.dtypes]
    if None in widths:
        return None
    return df.count() <= BROADCAST_BYTES // (ROW_OVERHEAD_BYTES + sum(widths))


def join_spread(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    spread_by: list[str],
    residual: Column | None = None,
    hot_in: DataFrame | HotKeys | None = None,
) -> DataFrame:
    """Join a large ``left`` to a side with few rows per key.

    A provably small ``right`` is broadcast: no shuffle, so no skew. Otherwise rows of
    hot keys are cut into parts of about half a shuffle partition, by a hash of
    ``spread_by`` (columns that differ between rows of one key, so a retried task picks
    the same part); parts are hashed to partitions, a few of which get several. Only the hot
    rows of ``right`` are repeated, once per part of their key. ``residual`` is a
    further condition over columns of both sides. ``hot_in`` is a cheaper frame with the
    same keys to look for hot ones in, if ``left`` is itself the result of a join, or the
    hot keys of such a frame, shared by several joins.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat salted rows")
    fits = fits_broadcast(right)
    if fits:
        right = F.broadcast(right)
    elif hot := _hot_keys(left if hot_in is None else hot_in, keys):
        # at most two rows per shuffle partition
        parts = left.sparkSession.createDataFrame([*hot.items()], "_hot long, _parts int")

        def with_parts(side: DataFrame) -> DataFrame:
            return side.withColumn("_hot", F.xxhash64(*keys)).join(F.broadcast(parts), "_hot", "left")

        salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_parts")).cast("int"))
        salts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
        left = with_parts(left).withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hot", "_parts")
        right = with_parts(right).withColumn("_salt", F.explode(salts)).drop("_hot", "_parts")
        keys = [*keys, "_salt"]
    if fits is False:
        right = right.hint("merge")  # the optimizer's statistics may still call it small
    if residual is None:
        return left.join(right, keys, how).drop("_salt")
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matches = reduce(and_, [F.col(k) == F.col(f"_right_{k}") for k in keys], residual)
    return left.join(renamed, matches, how).drop("_salt", *[f"_right_{k}" for k in keys])


def _hot_keys(hot_in: DataFrame | HotKeys, keys: list[str]) -> dict[int, int]:
    return hot_in.of(keys) if isinstance(hot_in, HotKeys) else find_hot_keys(hot_in, keys)
