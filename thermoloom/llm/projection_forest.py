"""Operator 6: embedding near-duplicates by a random-projection tree forest.

Every tree splits the space again and again at the median of a random
projection; a vector near the cut goes to both sides (spill), so near pairs are
rarely parted, and hardly ever in all trees. The upper part of the trees is
fitted on a bounded sample and routes all vectors to leaves; large leaves are
split on within their task. Vectors are compared inside leaves only, in double
precision; the verified pairs of all trees are united.

Equal vectors are one class before anything else. A leaf with more rows than a
block is dealt to one task per pair of its blocks, so a crowd of near copies is
spread out and no task holds more than two blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, running, stored
from .graph import components

COSINE = 0.95
TREES = 6
#: The trees are fitted on so many distinct vectors at most, chosen by a hash.
FIT_VECTORS = 20_000
LEAF_ROWS = 256
BLOCK_ROWS = 2_000
SEED = 6
#: Directions tried for a split, and the quantiles at which each may cut.
TRIES = 4
SHARES = (0.5, 0.35, 0.65, 0.2, 0.8)
#: Part of the pairs that a split may leave.
WORTH = 0.9
#: Levels of the routing trees, of which each has a bit in a mark of 64; the splits
#: within a task use the upper ones.
MOST_DEPTH = 32
NO_ID = -(2**63)


@dataclass(frozen=True)
class Tree:
    """Inner nodes in breadth-first numbering; children are inner nodes (>= 0) or
    leaves (-1 - leaf)."""

    directions: np.ndarray
    cuts: np.ndarray
    children: np.ndarray
    spill: float

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, left) of unit vectors; a row near a cut has several leaves.

        Bit d of ``left`` is set where the way to the leaf turns right at depth d
        and the row went left as well.
        """
        if not len(self.cuts):
            return np.arange(len(x)), np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        rows, leaves, marks, todo = [], [], [], [(0, np.arange(len(x)), np.zeros(len(x), np.int64), 0)]
        while todo:
            node, own, left, depth = todo.pop()
            if node < 0:
                rows.append(own)
                leaves.append(np.full(len(own), -1 - node))
                marks.append(left)
                continue
            at = x[own] @ self.directions[node] - self.cuts[node]
            low, high = at <= self.spill, at >= -self.spill
            for child, part, mark in zip(self.children[node], (low, high), (left, left | low.astype(np.int64) << depth), strict=True):
                if part.any():
                    todo.append((int(child), own[part], mark[part], depth + 1))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(leaves), np.concatenate(marks)


def _spill(dimension: int, cosine: float) -> float:
    """Half a standard deviation of the projected gap of a pair at the limit."""
    return 0.5 * float(np.sqrt((2 - 2 * cosine) / max(1, dimension)))


def _split(x: np.ndarray, spill: float, rng: np.random.Generator) -> tuple[np.ndarray, float, np.ndarray, np.ndarray] | None:
    """Direction, cut and both sides of the split with the fewest pairs left to
    compare; None if none leaves clearly fewer than there were.

    A first direction whose median parts the rows well is taken at once. Where a
    crowd of near copies lies on the median, other quantiles cut beside it.
    """
    best = None
    for _ in range(TRIES):
        direction = rng.standard_normal(x.shape[1])
        direction /= np.linalg.norm(direction)
        at = x @ direction
        ordered = np.sort(at)
        for share in SHARES:
            cut = float(ordered[int(share * (len(x) - 1))])
            low = np.searchsorted(ordered, cut + spill, "right") / len(x)
            high = 1 - np.searchsorted(ordered, cut - spill, "left") / len(x)
            pairs = low * low + high * high
            if pairs < (best[0] if best else WORTH):
                best = pairs, direction, cut, at
            if share == 0.5 and pairs < 0.7:
                break
        if best and best[0] < 0.7:
            break
    if best is None:
        return None
    _, direction, cut, at = best
    return direction, cut, at <= cut + spill, at >= cut - spill


def fit_tree(sample: np.ndarray, leaf_rows: int, cosine: float, seed: int) -> Tree:
    """Split until a leaf holds ``leaf_rows`` rows of the sample; a split that
    parts nobody ends a branch."""
    rng = np.random.default_rng(seed)
    spill = _spill(sample.shape[1] if sample.ndim == 2 else 1, cosine)
    directions, cuts, children, leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), None, 0, 0)]
    while todo:
        own, parent, side, depth = todo.pop(0)
        node = None
        if len(own) > leaf_rows and depth < MOST_DEPTH and (found := _split(sample[own], spill, rng)):
            direction, cut, low, high = found
            node = len(cuts)
            directions.append(direction)
            cuts.append(cut)
            children.append([0, 0])
            todo += [(own[low], node, 0, depth + 1), (own[high], node, 1, depth + 1)]
        if node is None:
            node, leaves = -1 - leaves, leaves + 1
        if parent is not None:
            children[parent][side] = node
    return Tree(np.array(directions), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), spill)


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that large components cannot overflow."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _vectors(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _route(trees: dict[int, list[Tree]]):
    schema = pa.schema([("leaf", pa.int64()), ("node", pa.int64()), ("left", pa.int64()), ("unit", pa.list_(pa.float64()))])

    one_leaf = Tree(np.zeros((0, 1)), np.zeros(0), np.zeros((0, 2), np.int64), 0.0)

    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column("embedding").offsets.to_numpy())
            for d in np.unique(sizes):
                own = batch.filter(pa.array(sizes == d))
                node, x = own.column("node").to_numpy(), _unit(_vectors(own.column("embedding")))
                for t, tree in enumerate(trees.get(int(d), [one_leaf])):
                    rows, leaf, left = tree.leaves(x)
                    for a in range(0, len(rows), 5000):
                        part = x[rows[a : a + 5000]]
                        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * d), pa.array(part.ravel()))
                        key = (int(d) << 40) + (t << 32) + leaf[a : a + 5000]
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[rows[a : a + 5000]]), pa.array(left[a : a + 5000]), flat], schema=schema)

    return run


def near_pairs(x: np.ndarray, left: np.ndarray, first: np.ndarray, cosine: float, seed: int, depth: int = 0) -> np.ndarray:
    """Pairs of rows at ``cosine`` or nearer, one with ``first`` set and one
    without, or any two if all are set; large sets are split on by random
    projections with spill.

    A pair that went left together is left to that side, so that a tree names it
    about once and not in every leaf where spill brings it together.
    """
    both = first.all()
    if len(x) > LEAF_ROWS and depth < 30:
        parted = _split(x, _spill(x.shape[1], cosine), np.random.default_rng((seed % (1 << 63), depth)))
        if parted:
            _, _, low, high = parted
            found = [np.zeros((0, 2), np.int64)]
            for k, (part, mark) in enumerate(((low, left), (high, left | low.astype(np.int64) << (62 - depth)))):
                own = np.flatnonzero(part)
                if both or (first[own].any() and not first[own].all()):
                    found.append(own[near_pairs(x[own], mark[own], first[own], cosine, seed * 2 + k, depth + 1)])
            return np.concatenate(found)
    if both:
        a, b = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    else:
        one, two = np.flatnonzero(first), np.flatnonzero(~first)
        a, b = np.nonzero(x[one] @ x[two].T >= cosine)
        a, b = one[a], two[b]
    once = (left[a] & left[b]) == 0
    return np.column_stack([a[once], b[once]])


def _compare(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        node, left = table.column("node").to_numpy(), table.column("left").to_numpy()
        x = _vectors(table.column("unit").combine_chunks())
        one, two = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        first = np.ones(len(node), bool) if one == two else table.column("block").to_numpy() == one
        pairs = near_pairs(x, left, first, cosine, int(table.column("leaf")[0].as_py() % 1_000_003))
        a, b = node[pairs[:, 0]], node[pairs[:, 1]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _dimensions(classes: DataFrame, cosine: float, fit_vectors: int) -> dict[int, list[Tree]]:
    """Trees for every length of vector, from a bounded sample."""
    total = classes.count()
    rows = classes.orderBy("node").limit(fit_vectors).select("embedding").toPandas()["embedding"]
    trees = {}
    for d in sorted({len(r) for r in rows}):
        sample = _unit(np.array([r for r in rows if len(r) == d], float))
        leaf = max(16, LEAF_ROWS * len(rows) // max(1, total))
        trees[d] = [fit_tree(sample, leaf, cosine, SEED * 1000 + t) for t in range(TREES)]
    return trees


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, fit_vectors: int = FIT_VECTORS) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors``.

    ``vectors`` needs vec_id and embedding (array of float or double). Vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing; vectors of different lengths do not link. Repeated rows and equal
    vectors link with each other. Rows that share a vec_id are vectors of their
    own. A null vec_id is never kept and names no component unless all members
    lack an id. Lengths that the sample has not seen are compared in one tree of
    one leaf, in blocks.
    """
    spark = vectors.sparkSession
    rows = columns(vectors, "vec_id", "embedding").select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    valid = F.coalesce(F.forall("embedding", fine) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    # adding zero turns -0.0 into 0.0
    rows = rows.withColumn("node", F.when(valid, F.xxhash64(F.transform("embedding", lambda v: v + 0.0))))
    with running(spark):
        classes = stored(rows.where("node is not null").groupBy("node").agg(F.first("embedding").alias("embedding"), F.min(F.when(F.col("vec_id") != NO_ID, F.col("vec_id"))).alias("label"), F.count("*").alias("k")), "classes")
        trees = _dimensions(classes, cosine, fit_vectors)
        routed = stored(classes.select("node", "embedding").mapInArrow(_route(trees), "leaf long, node long, left long, unit array<double>"), "leaves")
        blocks = routed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        dealt = routed.join(blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        dealt = dealt.select("leaf", "node", "left", "unit", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
        pairs = stored(dealt.groupBy("leaf", "one", "two").applyInArrow(_compare(cosine), "a long, b long").distinct(), "pairs")
        sizes = classes.select("node", "k")
        ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = ends.join(sizes, ends["b"] == sizes["node"]).groupBy(F.col("a").alias("node")).agg(F.sum("k").alias("more"))
        named = classes.select("node", "label", "k").join(components(pairs), "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = named.groupBy("root").agg(F.min("label").alias("component_id"))
        found = stored(named.join(least, "root").join(links, "node", "left").select("node", (F.col("k") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id"), "links")
    null = F.lit(NO_ID)
    out = rows.select("vec_id", "node").join(found, "node", "left")
    own = F.nullif("vec_id", null)
    component = F.when(F.col("node").isNull(), own).otherwise(F.col("component_id"))
    return out.select(own.alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(own == component, F.lit(False)).alias("kept"))
