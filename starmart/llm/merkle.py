"""Merkle manifest of a table: one tree per source, one tree over the sources, proofs per row.

Nodes carry nested-interval labels. Leaves are numbered once along (source, doc_id); a node is
labelled with its level and the half-open interval of leaf numbers it covers, so a node lies
below another exactly if its interval lies inside. No pointers are kept.

1. Leaf digests are column expressions. One range sort numbers the leaves; a hot source is many
   tasks of it.
2. Every level groups runs of ``FANOUT`` nodes of the level below by arithmetic on the labels
   and writes them; a level has a ``FANOUT``-th of the rows. A tree ends where one node covers it.
3. Proofs go down. A level's nodes meet their parents by containment: both are put in buckets as
   wide as the widest parent of that level, a parent in the one or two buckets its interval
   touches. A bucket holds at most ``2 * FANOUT + 2`` parents, whatever the sources' sizes, as a
   tree without a node of that level holds none. Siblings are the children of the parent that lie
   in the difference of both intervals: left of the node, and right of it. A node adds this
   step to its parent's path, so paths are long only on the last, single join with the leaves.

Defined results
    null in any column      hashed as ``-``; a null source is a source of its own and the first
    empty or long text      hashed whole
    ties, repeated rows     rows of one source and id follow each other by digest; each is a leaf
    empty table             empty result, and no root
    clashing extra columns  only the five columns of the leaf are read
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import land

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_POSITION_BITS = 33  # bits that Spark keeps for the row within its partition
_STEP = "struct<left:string,right:string>"


# --- leaves -------------------------------------------------------------------------


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the values, each with its length in bytes in front."""
    cells = []
    for value in values:
        text = value.cast("string")
        cells.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*cells).cast("binary"), 256)


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, changed: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, source, leaf, seen): ``seen`` is the digest after ``changed`` replaces columns."""
    id_column, source = columns[:2]
    now = changed or {}
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source).alias("source"),
        leaf_digest([F.col(c) for c in columns]).alias("leaf"),
        leaf_digest([now.get(c, F.col(c)) for c in columns]).alias("seen"),
    )


def _numbered(rows: DataFrame, order_by: list[str], tree: str | None) -> DataFrame:
    """``lo``, the row's place in the whole order, and ``base`` and ``size`` of its tree.

    Range sort, then one offset per partition; a tree's extent is added up from its parts in
    the partitions, so no task holds a tree.
    """
    row = F.monotonically_increasing_id()
    rows = land(rows.withColumn("_row", row), "merkle-rows")  # the last tie, the same for every reader
    sorted_rows = land(rows.orderBy(*order_by, "_row").withColumn("_at", row), "merkle-sorted").select(
        *rows.columns,
        F.shiftright("_at", _POSITION_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
        (F.col(tree) if tree else F.lit("")).alias("_tree"),
    )
    parts = land(sorted_rows.groupBy("_part", "_tree").agg(F.min("_pos").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-parts")
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = parts.groupBy("_part").agg(F.sum("n").alias("n")).select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    whole = W.partitionBy("_tree")
    extents = parts.join(offsets, "_part").select(
        "_part",
        "_tree",
        "offset",
        F.min(F.col("offset") + F.col("first")).over(whole).alias("base"),
        F.sum("n").over(whole).alias("size"),
    )
    same = (F.col("s._part") == F.col("e._part")) & F.col("s._tree").eqNullSafe(F.col("e._tree"))
    joined = sorted_rows.alias("s").join(extents.alias("e"), same)
    kept = [F.col(f"s.{c}") for c in rows.columns if c != "_row"]
    return joined.select(*kept, (F.col("e.offset") + F.col("s._pos")).alias("lo"), "e.base", "e.size")


# --- up: nodes ----------------------------------------------------------------------


def _parents(below: DataFrame, level: int, fanout: int) -> DataFrame:
    """Nodes of ``level`` with their children in order, from the nodes of the level below."""
    width = fanout**level
    run = F.expr(f"(lo - base) div {width}")
    children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))  # at most FANOUT
    made = (
        below.filter(F.col("size") > fanout ** (level - 1))
        .groupBy("base", "size", run.alias("run"))
        .agg(children.alias("children"))
    )
    joined = F.array_join(F.transform("children", lambda c: c["digest"]), "")
    lo = F.col("base") + F.col("run") * width
    return made.select(
        lo.alias("lo"),
        F.least(lo + width, F.col("base") + F.col("size")).alias("hi"),
        "base",
        "size",
        F.sha2(joined.cast("binary"), 256).alias("digest"),
        "children",
    )


def _levels(ground: DataFrame, fanout: int) -> list[DataFrame]:
    """Nodes by level, each written; level 0 are the leaves (lo, hi, base, size, digest)."""
    levels = [ground]
    largest = ground.agg(F.max("size")).first()[0] or 0
    while largest > fanout ** (len(levels) - 1):
        levels.append(land(_parents(levels[-1], len(levels), fanout), f"merkle-level-{len(levels)}"))
    return levels


def _tops(levels: list[DataFrame], fanout: int) -> DataFrame:
    """The root of each tree: the node of the first level whose width covers the tree."""
    tops = None
    for level, nodes in enumerate(levels):
        covers = nodes.filter(F.col("size") <= fanout**level).select("lo", "hi", "digest")
        tops = covers if tops is None else tops.unionByName(covers)
    return tops


# --- down: paths --------------------------------------------------------------------


def _with_parents(nodes: DataFrame, parents: DataFrame, level: int, fanout: int) -> DataFrame:
    """Nodes of ``level`` with the columns of the parent whose interval holds theirs."""
    width = fanout ** (level + 1)  # the widest parent

    def bucket(place):
        return F.expr(f"({place}) div {width}")

    touched = F.array_distinct(F.array(bucket("lo"), bucket("hi - 1")))
    above = parents.select(
        F.explode(touched).alias("bucket"),
        F.struct("lo", "hi", "children", "path", "subroot").alias("parent"),
    )
    below = nodes.withColumn("bucket", bucket("lo"))
    holds = (F.col("below.bucket") == F.col("above.bucket")) & (F.col("parent.lo") <= F.col("below.lo")) & (F.col("below.hi") <= F.col("parent.hi"))
    return below.alias("below").join(above.alias("above"), holds).drop("bucket")


def _step() -> Column:
    """Digests of the siblings: the parent's children in the parent's interval without the node's."""
    left = F.filter("parent.children", lambda c: c["hi"] <= F.col("lo"))
    right = F.filter("parent.children", lambda c: c["lo"] >= F.col("hi"))
    digests = lambda some: F.array_join(F.transform(some, lambda c: c["digest"]), "")
    return F.struct(digests(left).alias("left"), digests(right).alias("right")).cast(_STEP)


def _paths(levels: list[DataFrame], crown: DataFrame, fanout: int) -> DataFrame:
    """Leaves with ``path``, the steps from leaf to root, and ``subroot``.

    ``crown`` has one row per tree: ``lo``, the path from the tree's root on, ``subroot``.
    """
    reached = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        roots = nodes.filter(F.col("size") <= fanout**level).join(crown, "lo").select(*nodes.columns, "path", "subroot")
        if reached is None:
            reached = roots
            continue
        lower = _with_parents(nodes.filter(F.col("size") > fanout**level), reached, level, fanout)
        path = F.concat(F.array(_step()), F.col("parent.path"))
        lower = lower.select(*nodes.columns, path.alias("path"), F.col("parent.subroot").alias("subroot"))
        reached = roots.unionByName(lower)
    return reached


# --- the operator -------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """``nodes``: (tree, level, lo, hi, digest), ``tree`` being ``source`` or ``top``; ``rows``: one row per
    leaf with ``leaf``, ``seen``, ``subroot`` and ``path``; ``root`` is the digest of all."""

    nodes: DataFrame
    rows: DataFrame
    root: str | None


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, changed: dict[str, Column] | None = None, fanout: int = FANOUT) -> Manifest:
    """Trees over all rows; the first two ``columns`` are the id and the source."""
    numbered = _numbered(leaves(docs, columns, changed), ["source", "doc_id", "leaf"], "source")
    ground = numbered.select("lo", (F.col("lo") + 1).alias("hi"), "base", "size", F.col("leaf").alias("digest"), "doc_id", "source", "seen")
    by_source = _levels(land(ground, "merkle-leaves"), fanout)
    tops = _numbered(_tops(by_source, fanout).select(F.col("lo").alias("first"), "digest"), ["first"], None)
    tops = tops.select("lo", (F.col("lo") + 1).alias("hi"), "base", "size", "digest", "first")
    over_sources = _levels(land(tops, "merkle-subroots"), fanout)
    found = over_sources[-1].filter(F.col("size") <= fanout ** (len(over_sources) - 1)).select("digest").first()  # one row
    bare = docs.sparkSession.range(1).select(F.col("id").alias("lo"), F.expr(f"cast(array() as array<{_STEP}>)").alias("path"), F.lit(None).cast("string").alias("subroot"))
    crown = _paths(over_sources, bare, fanout).select(F.col("first").alias("lo"), "path", F.col("digest").alias("subroot"))
    rows = _paths(by_source, land(crown, "merkle-crown"), fanout)
    nodes = None
    for tree, levels in (("source", by_source), ("top", over_sources)):
        for level, some in enumerate(levels):
            some = some.select(F.lit(tree).alias("tree"), F.lit(level).alias("level"), "lo", "hi", "digest")
            nodes = some if nodes is None else nodes.unionByName(some)
    named = rows.select("doc_id", "source", F.col("digest").alias("leaf"), "seen", "subroot", "path")
    return Manifest(nodes, named, found[0] if found else None)


def proof(path: str = "path") -> Column:
    """The siblings' digests, level by level to the root, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""

    def up(digest, step):
        return F.sha2(F.concat(step["left"], digest, step["right"]).cast("binary"), 256)

    return F.aggregate(path, F.col(leaf), up)
