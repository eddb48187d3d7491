"""SimHash near-duplicates by the generalised pigeonhole principle.

1. Each text becomes a 64-bit fingerprint; equal fingerprints are one node from here on.
2. Bits that agree often are grouped, because a group of correlated bits separates less than
   its width suggests, and then only one group is weak.
3. Two fingerprints within ``distance`` bits are within t_i bits in at least one group i if
   the t_i sum to distance - groups + 1. Dynamic programming gives each group its t_i
   (-1: not probed) by the estimated number of candidate pairs; the number of groups is
   chosen by the same estimate.
4. Each fingerprint is filed under its own bits of a group and probes all values up to t_i
   bits away. A bucket is verified on all 64 bits and leaves a spanning set of links.
5. A bucket over ``bucket_rows`` is cut by groups of the remaining bits, in which the rest of
   the distance must fit again. No bucket is capped: with two cuts it agrees on 45 bits, so it
   cannot hold more than about 2^19 different fingerprints.

Defined results
    null text               counts as empty; no words: fingerprint 0, linked like any other
    fewer than three words  one shingle of the whole sequence
    very long text          fingerprinted whole
    ties, repeated rows     equal fingerprints share a component; its id is the least doc_id
                            (null only if all are null)
    empty table             empty result
    clashing extra columns  only the id and the text are read
"""

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import ROW_ID, identified, land, partitions
from starmart.llm.components import components

BITS = 64
SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
BUCKET_ROWS = 200_000  # a larger bucket is cut further
CUTS = 2

_PAIRWISE_ROWS = 2_000  # up to here all pairs of a bucket are compared, beyond it masks are sorted


# --- fingerprints -------------------------------------------------------------------


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII space only
    if not words:
        return 0
    n = min(shingle_words, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], seed) for a, b in zip(starts, (ends[n - 1 :] - 1).tolist())),
        dtype="<u8",
        count=len(starts),
    )
    ones = np.zeros(BITS, np.int64)
    for part in np.split(hashes, range(65536, len(hashes), 65536)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches, shingle_words, seed):
    for batch in batches:
        texts = batch.column(1)
        prints = np.array([fingerprint(t.as_py(), shingle_words, seed) for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)], ["doc_id", "print", ROW_ID]
        )


def fingerprints(docs: DataFrame, id_column="doc_id", text="text", shingle_words=SHINGLE_WORDS, seed=SEED) -> DataFrame:
    """(doc_id, print, row id) for every document of an identified table; written once."""
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), ROW_ID)
    made = chosen.mapInArrow(
        partial(_fingerprints, shingle_words=shingle_words, seed=seed), f"doc_id bigint, print bigint, {ROW_ID} bigint"
    )
    return land(made, "fingerprints")


# --- groups of bits and their thresholds --------------------------------------------


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows, and for each pair of bits the rows that have both."""
    rows, both = 0, np.zeros((BITS, BITS))
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(prints, axis=1, bitorder="little").astype(np.float32)
        rows, both = rows + len(bits), both + bits.T @ bits
    yield pa.RecordBatch.from_arrays([pa.array(range(BITS * BITS)), pa.array(both.ravel()), pa.array([rows] * BITS * BITS)], ["cell", "both", "rows"])


def agreement(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and the matrix of correlations between bits. 4096 sums leave the executors."""
    sums = prints.select("print").mapInArrow(_moments, "cell bigint, both double, rows bigint")
    cells = sums.groupBy("cell").agg(F.sum("both").alias("both"), F.sum("rows").alias("rows")).collect()
    if not cells or not cells[0].rows:
        return 0, np.eye(BITS)
    rows = cells[0].rows
    both = np.zeros(BITS * BITS)
    for c in cells:
        both[c.cell] = c.both / rows
    both = both.reshape(BITS, BITS)
    share = np.diag(both)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return rows, (both - np.outer(share, share)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, groups: int, bits: list[int] | None = None) -> list[list[int]]:
    """Equal groups; each grows from a seed by the bit most correlated with its members."""
    free = list(range(BITS)) if bits is None else list(bits)
    strength, out = np.abs(correlation), []
    for g in range(groups, 0, -1):
        width = len(free) // g
        seed = max(free, key=lambda b: (strength[b, free].sum(), -b))
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            best = max(free, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _same_pairs(prints: DataFrame, groups: list[list[int]]) -> list[float]:
    """For each group, the number of pairs of fingerprints that agree on all its bits."""
    masked = F.explode(
        F.array(*[F.struct(F.lit(i).alias("g"), F.col("print").bitwiseAND(F.lit(_signed(_mask(b)))).alias("v")) for i, b in enumerate(groups)])
    ).alias("s")
    counts = prints.select(masked).groupBy("s.g", "s.v").count()
    n = F.col("count").cast("double")
    pairs = counts.groupBy("g").agg(F.sum(n * (n - 1) / 2).alias("pairs")).collect()
    found = {p.g: p.pairs for p in pairs}
    return [found.get(i, 0.0) for i in range(len(groups))]


def allocate(same: list[float], widths: list[int], rows: int, distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds (-1 to ``distance``) that sum to distance - groups + 1.

    Within t bits there are about as many pairs as agree, times the ways to flip up to t
    bits. Values that are probed cost a row each, candidates a comparison each.
    """
    def cost(g, t):
        ways = sum(comb(widths[g], j) for j in range(t + 1))
        chance = rows * (rows - 1) / 2 * 2.0 ** -widths[g]
        return 0.0 if t < 0 else rows * ways + max(same[g], chance) * ways

    best = {0: (0.0, [])}
    for g in range(len(widths)):
        step = {}
        for total, (spent, chosen) in best.items():
            for t in range(-1, distance + 1):
                offer = (spent + cost(g, t), [*chosen, t])
                if total + t not in step or offer[0] < step[total + t][0]:
                    step[total + t] = offer
        best = step
    return best[distance - len(widths) + 1]


def plan_groups(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the cheapest grouping."""
    rows, correlation = agreement(prints)
    offers = []
    for m in range(1, distance + 2):
        groups = group_bits(correlation, m)
        spent, chosen = allocate(_same_pairs(prints, groups), [len(g) for g in groups], rows, distance)
        offers.append((spent, list(zip(groups, chosen))))
    return min(offers, key=lambda o: o[0])[1]


# --- probing and verifying ----------------------------------------------------------


def _bits_key(path: Column, masks: dict[int, int]) -> Column:
    """The print's bits under the mask of the row's path."""
    options = iter(masks.items())
    chosen = F.coalesce(*[F.when(path == p, F.lit(_signed(m))) for p, m in options])
    return F.col("print").bitwiseAND(chosen)


def _flipped(g: int, own: Column):
    return lambda flip: F.struct(F.lit(g).alias("g"), own.bitwiseXOR(flip).alias("v"))


def _signatures(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(key, path, print): every fingerprint under its own and all probed values of each group.

    The path is the number of the group."""
    keys = []
    for g, (bits, most) in enumerate(plan):
        flips = [_signed(_mask(list(f))) for t in range(most + 1) for f in combinations(bits, t)]
        if not flips:
            continue
        own = F.col("print").bitwiseAND(F.lit(_signed(_mask(bits))))
        table = F.array(*[F.lit(f).cast("long") for f in flips])
        keys.append(F.transform(table, _flipped(g, own)))
    named = prints.select("print", F.explode(F.concat(*keys)).alias("s"))
    return named.select(F.xxhash64("s.g", "s.v").alias("key"), F.col("s.g").alias("path"), "print")


def _cut(rows: DataFrame, used: dict[int, list[int]], distance: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """File the rows of large buckets by parts of the bits that their path has not used.

    Of distance + 1 parts one agrees, so every linked pair of a bucket meets again.
    """
    n = distance + 1
    free = {p: [b for b in range(BITS) if b not in bits] for p, bits in used.items()}
    parts = {p: [f[len(f) * i // n : len(f) * (i + 1) // n] for i in range(n)] for p, f in free.items()}
    keys = [
        F.struct(
            (F.col("path") * n + i).alias("path"),
            _bits_key(F.col("path"), {p: _mask(part[i]) for p, part in parts.items()}).alias("v"),
        )
        for i in range(n)
    ]
    named = rows.select("key", "print", F.explode(F.array(*keys)).alias("s"))
    cut = named.select(F.xxhash64("key", "s.path", "s.v").alias("key"), "s.path", "print")
    return cut, {p * n + i: used[p] + part[i] for p, part in parts.items() for i in range(n)}


def spanning_links(prints: np.ndarray, distance: int) -> np.ndarray:
    """Links (i, j) that connect what is within ``distance`` bits; one chain per class.

    Small buckets compare all pairs in blocks. In a large one, two fingerprints within the
    distance are equal after masking the bits in which they differ; sorting by each masked
    value brings them together, in time that grows with the rows and not with their square.
    """
    n = len(prints)
    parent = np.arange(n)

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []

    def join(left, right):
        label = parent.copy()
        while (label != label[label]).any():
            label = label[label]
        apart = label[left] != label[right]
        for a, b in zip(left[apart].tolist(), right[apart].tolist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((a, b))

    if n <= _PAIRWISE_ROWS:
        for low in range(0, n, 256):
            near = np.bitwise_count(prints[low : low + 256, None] ^ prints[None, :]) <= distance
            left, right = np.nonzero(near)
            later = right > left + low
            join(left[later] + low, right[later])
    else:
        for flipped in combinations(range(BITS), distance):
            value = prints & np.uint64(~_mask(list(flipped)) & (2**64 - 1))
            order = np.argsort(value)
            twins = value[order][1:] == value[order][:-1]
            join(order[:-1][twins], order[1:][twins])
    return np.array(links, np.int64).reshape(-1, 2)


def _link_buckets(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, print); a bucket may run over several batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(keys, prints):
        if not len(keys):
            return
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        sizes = ends - starts
        left, right = [], []
        two = starts[sizes == 2]
        near = two[np.bitwise_count(prints[two] ^ prints[two + 1]) <= distance]
        left.append(prints[near])
        right.append(prints[near + 1])
        for s, e in zip(starts[sizes > 2], ends[sizes > 2]):
            bucket = np.unique(prints[s:e])
            found = spanning_links(bucket, distance)
            left.append(bucket[found[:, 0]])
            right.append(bucket[found[:, 1]])
        a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    held = []
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        last = np.searchsorted(keys, keys[-1]) if keys[0] != keys[-1] else 0
        if last or (held and held[0][0][0] != keys[0]):
            whole = [*held, (keys[:last], prints[:last])]
            yield from linked(np.concatenate([k for k, _ in whole]), np.concatenate([p for _, p in whole]))
            held = []
        held.append((keys[last:], prints[last:]))
    if held:
        yield from linked(np.concatenate([k for k, _ in held]), np.concatenate([p for _, p in held]))


def links(prints: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all within the distance."""
    plan = plan_groups(prints, distance)
    rows, used = _signatures(prints, plan), {g: bits for g, (bits, _) in enumerate(plan)}
    verified = []
    for _ in range(CUTS):
        # at most rows / bucket_rows keys, each with more than bucket_rows rows
        large = land(rows.groupBy("key").count().filter(F.col("count") > bucket_rows).select("key"), "large")
        if not large.head(1):
            break
        verified.append(_verify(rows.join(large, "key", "left_anti"), distance))
        rows, used = _cut(rows.join(large, "key", "left_semi"), used, distance)
    verified.append(_verify(rows, distance))
    return land(reduce(DataFrame.unionByName, verified), "links")


def _verify(rows: DataFrame, distance: int) -> DataFrame:
    n = partitions(rows.sparkSession)
    dealt = rows.repartition(n, "key").sortWithinPartitions("key", "print")
    return dealt.select("key", "print").mapInArrow(partial(_link_buckets, distance=distance), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_column="doc_id", text="text", shingle_words=SHINGLE_WORDS, distance=DISTANCE, bucket_rows=BUCKET_ROWS) -> DataFrame:
    """One row per document: row id, id, ``print`` (signed), ``component_id``, ``kept``.

    ``kept`` marks one document of each component: the least id, of equal ids the first by file and place.
    """
    return _near_duplicates(identified(docs), id_column, text, shingle_words, distance, bucket_rows)


def _near_duplicates(docs, id_column, text, shingle_words, distance, bucket_rows) -> DataFrame:
    marked = fingerprints(docs, id_column, text, shingle_words)
    id_order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW_ID)
    nodes = land(marked.groupBy("print").agg(F.min(id_order).alias("least")), "nodes")
    found = components(links(nodes.select("print"), distance, bucket_rows))
    rooted = nodes.join(found, nodes.print == found.node, "left").select(
        "print", F.coalesce("root", "print").alias("root"), "least"
    )
    # a class of a third of all fingerprints is aggregated map-side before it meets
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    classes = land(rooted.join(least, "root").select("print", "first"), "classes")
    return marked.join(classes, "print").select(
        ROW_ID,
        "doc_id",
        "print",
        F.col("first.doc_id").alias("component_id"),
        (F.col(ROW_ID) == F.col(f"first.{ROW_ID}")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_column="doc_id", text="text", shingle_words=SHINGLE_WORDS, distance=DISTANCE, bucket_rows=BUCKET_ROWS) -> DataFrame:
    """One document of each component, with its own columns; the dropped ones are joined away."""
    numbered = identified(docs)
    found = _near_duplicates(numbered, id_column, text, shingle_words, distance, bucket_rows)
    dropped = land(found.filter("not kept").select(ROW_ID), "dropped")
    return numbered.join(dropped, ROW_ID, "left_anti").select(*docs.columns)
