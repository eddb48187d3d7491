"""Total orders without a single task: sequential ids and global ranks.

Both sort by range, write the sorted rows once with their position, and turn positions
into global numbers with one small offset per partition.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.operators.skew import HotKeys, join_spread
from starmart.storage import land

_POSITION_BITS = 33


def _land_sorted(df: DataFrame, order_by: list[Column], name: str) -> DataFrame:
    """Sorted rows with their partition (``_part``) and place in it (``_pos``).

    Written before use: range bounds are sampled and may differ between evaluations.
    """
    numbered = df.orderBy(*order_by).withColumn("_mid", F.monotonically_increasing_id())
    landed = land(numbered, name)
    position = F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return landed.select(
        *df.columns,
        F.shiftright("_mid", _POSITION_BITS).cast("int").alias("_part"),
        position.alias("_pos"),
    )


def _offsets(sorted_rows: DataFrame, weight: Column, *groups: str) -> DataFrame:
    """Total weight of all earlier partitions, per group; one row per group and partition."""
    totals = sorted_rows.groupBy(*groups, "_part").agg(F.sum(weight).alias("_total"))
    by_part = W.partitionBy(*groups) if groups else W
    earlier = by_part.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *groups, "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )


def assign_sequential_id(df: DataFrame, id_name: str, order_by: list[str]) -> DataFrame:
    """Number rows 1..n along ``order_by``, which must be unique."""
    rows = _land_sorted(df, [F.col(c).asc_nulls_first() for c in order_by], "sequence")
    offsets = F.broadcast(_offsets(rows, F.lit(1)))
    return rows.join(offsets, "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(id_name), *df.columns
    )


def global_rank(df: DataFrame, value: str, rank_name: str, spread_by: list[str]) -> DataFrame:
    """``rank() over (order by value desc nulls last)`` as a distributed job.

    Ties are collapsed before the sort, so neither a value shared by a third of the
    rows nor the number of rows decides the size of a task.
    """
    return _with_ranks(df, {rank_name: value}, spread_by)


def rank_all(df: DataFrame, ranks: dict[str, str], spread_by: list[str]) -> DataFrame:
    """Add one descending rank per entry of ``ranks`` ({rank name: value column}).

    One pass collapses the ties of all value columns, one sort puts them in order.
    """
    return _with_ranks(land(df, "to_rank"), ranks, spread_by)


def _with_ranks(df: DataFrame, ranks: dict[str, str], spread_by: list[str]) -> DataFrame:
    placed = _places(df, list(ranks.values()))
    keyed = df.withColumns(
        {
            name: column
            for i, value in enumerate(ranks.values())
            for name, column in zip(_rank_key(i), _without_null(F.col(value), df, value))
        }
    )
    hot = HotKeys(keyed, *[_rank_key(i) for i in range(len(ranks))])
    ranked = keyed
    for i, (name, value) in enumerate(ranks.items()):
        missing, plain = _without_null(F.col(f"_value{i}"), df, value)
        mine = placed.filter(F.col("_which") == i).select(
            *[c.alias(n) for n, c in zip(_rank_key(i), (missing, plain))], F.col("_rank").alias(name)
        )
        ranked = join_spread(ranked, mine, _rank_key(i), "inner", spread_by, hot_in=hot)
    return ranked.select(*df.columns, *ranks)


def _places(df: DataFrame, values: list[str]) -> DataFrame:
    """The rank of every different value, for all columns at once.

    A row names its column (``_which``) and holds the value in ``_value<which>``; the other
    value columns are NULL there, so each keeps its own type and order.
    """
    columns = [f"_value{i}" for i in range(len(values))]

    def entry(which: int) -> Column:
        own = [F.when(F.lit(i == which), F.col(v)).alias(c) for i, (c, v) in enumerate(zip(columns, values))]
        return F.struct(F.lit(which).alias("_which"), *own)

    entries = df.select(F.inline(F.array(*[entry(i) for i in range(len(values))])))
    ties = entries.groupBy("_which", *columns).agg(F.count(F.lit(1)).alias("_ties"))
    order = [F.col("_which").asc(), *[F.col(c).desc_nulls_last() for c in columns]]
    rows = _land_sorted(ties, order, "ranks")
    offsets = F.broadcast(_offsets(rows, F.col("_ties"), "_which"))
    before = W.partitionBy("_which", "_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_ties").over(before), F.lit(0))
    return rows.join(offsets, ["_which", "_part"]).select(
        "_which", *columns, (F.col("_offset") + earlier + 1).alias("_rank")
    )


def _rank_key(which: int) -> list[str]:
    return [f"_no_value{which}", f"_plain{which}"]


def _without_null(column: Column, df: DataFrame, value: str) -> tuple[Column, Column]:
    """A NULL as a flag and a zero, so that an equality join finds it."""
    return column.isNull(), F.coalesce(column, F.lit(0).cast(df.schema[value].dataType))
