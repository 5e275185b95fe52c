"""Near-duplicate embeddings by a forest of random-projection trees with overlapping leaves.

Each tree splits vectors by random directions at the median; vectors within a margin of a split
go to both sides. Vectors are compared with those of their leaves only, by cosine in double
precision, and two vectors miss each other only if every tree has separated them. The trees are
fitted on a bounded sample (SAMPLE vectors, expected) that gives the medians; every vector is
routed through all trees.

Equal vectors are one class, known by a 64-bit hash. A leaf of more than BLOCK classes is compared
in blocks, two blocks a task. A pair that shares several leaves is counted in the first of them,
so links are counted, not emitted: a task returns a count per class and a spanning tree of its
links.

Vectors that are null, empty or zero, or hold null or non-finite components, and rows whose id is
null link with nothing. Vectors of different lengths never link. Rows that share an id are vectors
of their own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import components
from meterlark.session import materialize

#: Cosine from which two vectors are linked.
SIMILARITY = 0.95
#: Trees, and the margin of a split on either side, as a share of 1 / sqrt(length).
TREES, MARGIN = 8, 0.12
#: Vectors on which the trees are fitted, on average at most.
SAMPLE = 50_000
#: A node is split while it has more classes than this (estimated) and enough of the sample.
LEAF, LEAST_SAMPLE = 300, 12
#: Classes of a leaf that are compared at once.
BLOCK = 2000
SEED = 20240607


@dataclass
class Tree:
    """Inner nodes: direction, threshold and both children; a negative child -k-1 is leaf k."""

    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def route(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that each row of x reaches."""
        rows, nodes = np.arange(len(x)), np.zeros(len(x), np.int64)
        done_rows, done_leaves = [], []
        if not len(self.thresholds):
            return rows, nodes
        while len(rows):
            off = np.einsum("ij,ij->i", x[rows], self.directions[nodes]) - self.thresholds[nodes]
            left, right = off <= margin, off >= -margin
            rows, nodes = np.concatenate([rows[left], rows[right]]), np.concatenate([self.children[nodes[left], 0], self.children[nodes[right], 1]])
            out = nodes < 0
            done_rows.append(rows[out])
            done_leaves.append(-nodes[out] - 1)
            rows, nodes = rows[~out], nodes[~out]
        return np.concatenate(done_rows), np.concatenate(done_leaves)


def fit_tree(sample: np.ndarray, population: int, rng: np.random.Generator) -> Tree:
    """Split the sample at medians of random projections until leaves are small."""
    d = sample.shape[1]
    directions, thresholds, children, leaves = [], [], [], 0
    scale = population / max(1, len(sample))
    # (members of the sample, parent node, side)
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(sample)), -1, 0)]
    while todo:
        members, parent, side = todo.pop()
        split = None
        if len(members) * scale > LEAF and len(members) >= 2 * LEAST_SAMPLE:
            for _ in range(4):
                r = rng.standard_normal(d)
                r /= np.linalg.norm(r)
                p = sample[members] @ r
                t = float(np.median(p))
                if (p < t).any() and (p > t).any():
                    split = r, t, p <= t
                    break
        if split is None:
            at = -leaves - 1
            leaves += 1
        else:
            at = len(thresholds)
            directions.append(split[0])
            thresholds.append(split[1])
            children.append([0, 0])
            todo += [(members[split[2]], at, 0), (members[~split[2]], at, 1)]
        if parent >= 0:
            children[parent][side] = at
    return Tree(np.array(directions).reshape(-1, d), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), leaves)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first so that no square over- or underflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _classes(rows: DataFrame) -> DataFrame:
    """(v, size, copies, x) of the vectors that can link; v is a hash of the vector."""
    finite = ~F.exists("x", lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & finite & F.exists("x", lambda a: a != 0))
    return good.groupBy(F.xxhash64("x").alias("v"), F.size("x").alias("size")).agg(
        F.count("*").alias("copies"), F.min("id").alias("rep"), F.first("x").alias("x")
    )


def _fit(classes: DataFrame) -> dict[int, list[Tree]]:
    """Trees for each length of vectors."""
    sizes = {r["size"]: r["n"] for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    forests = {}
    for size, n in sorted(sizes.items()):
        share = int(min(1.0, SAMPLE / n) * (1 << 30))
        picked = classes.where((F.col("size") == size) & (F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= share)).select("x").toPandas()
        sample = unit(np.stack(picked["x"].to_list())) if len(picked) else np.zeros((0, size))
        rng = np.random.default_rng([SEED, size])
        forests[size] = [fit_tree(sample, n, rng) for _ in range(TREES)]
    return forests


def _routed(classes: DataFrame, forests: dict[int, list[Tree]]) -> DataFrame:
    """`classes` with `leaves`: ids of all leaves, of all trees, that each reaches."""
    shared = classes.sparkSession.sparkContext.broadcast(forests)

    def run(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                x = unit(_matrix(part.column(4), int(size)))
                rows, leaves, first = [], [], 0
                for tree in shared.value[int(size)]:
                    r, leaf = tree.route(x, MARGIN / size**0.5)
                    rows.append(r)
                    leaves.append(leaf + first)
                    first += tree.leaves
                rows, leaves = np.concatenate(rows), np.concatenate(leaves) + (int(size) << 40)
                order = np.lexsort((leaves, rows))
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(x)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves[order]))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*batch.schema.names, "leaves"])

    kind = classes.schema["x"].dataType.simpleString()
    rep = classes.schema["rep"].dataType.simpleString()
    return classes.mapInArrow(run, f"v long, size int, copies long, rep {rep}, x {kind}, leaves array<long>")


def _compared(routed: DataFrame) -> DataFrame:
    """(v, root, links): a count of links per class and leaf, and the smallest class it reaches there."""
    leaf = routed.select("v", F.explode("leaves").alias("leaf"))
    sizes = leaf.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = routed.select("v", "copies", "x", "leaves", F.explode("leaves").alias("leaf")).join(sizes, "leaf")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("v"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("leaf", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "v", "copies", "x", "leaves")

    def run(batches):
        held, task = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
                now = tuple(keys[:, a].tolist())
                if task is not None and now != task:
                    yield links_of(held, task)
                    held = []
                task = now
                held.append(batch.slice(a, b - a))
        if held:
            yield links_of(held, task)

    def links_of(held, task):
        part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        block, v, copies = (part.column(k).to_numpy() for k in (3, 4, 5))
        n = len(v)
        x = unit(_matrix(part.column(6), len(part.column(6)[0])))
        linked = x @ x.T >= SIMILARITY
        np.fill_diagonal(linked, False)
        if task[1] != task[2]:
            linked &= block[:, None] != block[None, :]
        some = np.flatnonzero(linked.any(1))
        if not len(some):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["v", "root", "links"])
        linked = linked[np.ix_(some, some)]
        # Leaves before this one that two of the classes share.
        lists = part.column(7)
        flat, ends = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        owner = np.repeat(np.arange(n), np.diff(ends))
        place = np.full(n, -1)
        place[some] = np.arange(len(some))
        keep = (flat < task[0]) & (place[owner] >= 0)
        known, column = np.unique(flat[keep], return_inverse=True)
        member = np.zeros((len(some), len(known)), np.float32)
        member[place[owner[keep]], column] = 1
        first_here = linked & ~((member @ member.T) > 0)
        links = (first_here * copies[some][None, :]).sum(1)
        ids = v[some]
        root = ids.copy()
        while True:
            lower = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1))
            if (lower == root).all():
                break
            root = lower
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root), pa.array(links.astype(np.int64))], ["v", "root", "links"])

    return rows.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j").mapInArrow(run, "v long, root long, links long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) of every row of `vectors`; runs jobs."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("x"))
    classes = materialize(_classes(rows), "vectors")
    routed = materialize(_routed(classes, _fit(classes)), "routed")
    found = materialize(_compared(routed), "leaf-links")
    component = components(found.select(F.col("v").alias("a"), F.col("root").alias("b")), "vectors")
    counts = found.groupBy("v").agg(F.sum("links").alias("links"))
    known = classes.select("v", "copies", "rep").join(counts, "v", "left").join(component.select(F.col("id").alias("v"), "component"), "v", "left")
    known = known.withColumn("component", F.coalesce("component", "v"))
    least = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = known.join(least, "component").select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    # A row without an id has no class.
    joined = rows.withColumn("v", F.when(F.col("id").isNotNull(), F.xxhash64("x"))).select("id", "v").join(known, "v", "left")
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component_id.cast("long").alias("component_id"),
        F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"),
    )
