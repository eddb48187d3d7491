"""Connected components of a graph of links, as joins and groupings.

Alternates large-star and small-star steps (Kiveris et al., 2014): each node sends its
neighbours to the smallest of them, until nothing moves. A step groups by node and
keeps one row per link. Each step is written to the shared folder, which cuts the
lineage; nothing but a count comes to the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import land


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the component's least node.

    Loops and repeated links are allowed; an empty table has no nodes.
    """
    pairs = land(_distinct(links.select("a", "b")), "links")
    state = _state(pairs)
    while True:
        large = _star(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = land(_star(large, larger=False), "links")
        before, state, pairs = state, _state(small), small
        if state == before:
            break
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _state(links: DataFrame) -> tuple:
    """Equal for equal tables: the number of links and two sums of their hashes."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(h), F.bit_xor(F.xxhash64(h, "b"))).first())


def _distinct(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours (the larger or the smaller ones) to the least of them."""
    # the least neighbour is aggregated before the join, so a hub is never one task's list
    least = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    joined = links.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return _distinct(moved)
