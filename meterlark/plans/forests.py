"""Bagged regression trees that grow until every leaf is pure, over categories and numbers.

A split sends the rows of one category, or those up to a number, to the left; it is the one that
takes away most of the squared error. Candidates whose gains differ by less than TIE of the gain
(or NOISE of the node's spread) count as equal, and then the first column and smallest value win,
so that trees do not depend on the order in which sums are taken.

Rows with equal features are points: a tree works on the total weight and target of each point. Each
task adds these up for its rows and all trees, so that only sums are shuffled, not drawn rows.
Nodes with more than `small` points are split by Spark, all trees together and level by level: one
aggregate over (tree, node, column, value), and the points are sent on by a join with the chosen
splits. Every other node is grown to its end inside one task, by exact splits, and becomes one row
of the subtree table. Scoring sends points down the same way: by joins through the splits, then
together with the rows of the subtrees they reach, in bounded portions.

Weights of bagging are Poisson draws from a hash of key, tree and seed, the same for any layout.
In nodes split by Spark, a number column with more than CANDIDATES different values is split at
that many of its quantiles; smaller nodes consider every value. A category that is null counts as
one of its own; null numbers count as the smallest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlark.session import materialize

#: Points of a node that one task grows to the end.
SMALL = 20_000
#: Thresholds that are tried for a number column of a larger node.
CANDIDATES = 512
#: Share of a gain, and of a node's weight times its squared range, by which candidates may differ and still tie.
TIE, NOISE = 1e-9, 1e-13
#: Points that are scored together with one subtree.
PORTION = 50_000
#: Splits of one level up to this number are broadcast, more are joined by a shuffle.
BROADCAST_SPLITS = 200_000
#: Combinations of features up to this number are broadcast, more are joined by a shuffle.
BROADCAST_POINTS = 100_000
#: Rows times trees that a task draws at once, sums that it holds before it hands them on, and hands on at once.
CELLS, HELD, EMITTED = 1_000_000, 4_000_000, 200_000
#: Tree and node of a point, its categories and numbers.
ROOT = 0


@dataclass
class Trees:
    """Splits of large nodes, one table per level, and the subtrees below them (one row each)."""

    categorical: list[str]
    numeric: list[str]
    trees: int
    subtrees: DataFrame
    levels: list[DataFrame] = field(default_factory=list)

    def nodes(self) -> DataFrame:
        """(tree, node, depth, is_leaf, points, weight, prediction) of every node inside the subtrees."""
        each = self.subtrees.select("tree", "node", "depth", F.explode(F.arrays_zip("at_depth", "split_on", "points", "weights", "values")).alias("x"))
        return each.select(
            "tree", "node", (F.col("depth") + F.col("x.at_depth")).alias("depth"), (F.col("x.split_on") < 0).alias("is_leaf"),
            F.col("x.points").alias("points"), F.col("x.weights").alias("weight"), F.col("x.values").alias("prediction"),
        )


def _features(categorical: Sequence[str], numeric: Sequence[str]) -> list[Column]:
    cats = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in categorical]
    missing = [F.when(F.col(c).isNull(), "-").otherwise("+") for c in categorical]
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(-math.inf)) for c in numeric]
    texts = [F.concat(m, c) for m, c in zip(missing, cats, strict=True)]
    return [F.array(*texts).cast("array<string>").alias("cats"), F.array(*numbers).cast("array<double>").alias("nums")]


def _drawn(hashes: np.ndarray) -> np.ndarray:
    """How often a row is drawn for a tree: Poisson with mean 1, from a hash."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(17)])
    return np.searchsorted(shares, (hashes.view(np.uint64) >> np.uint64(11)) / float(1 << 53), "right")


#: What becomes of the weights, targets, least and largest targets of a point's rows.
_ADDED = (np.add, np.add, np.minimum, np.maximum)


def _by_point(points: np.ndarray, columns: Sequence[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Each point once, and what its rows in `columns` (one column per tree) come to."""
    order = np.argsort(points, kind="stable")
    names, first = np.unique(points[order], return_index=True)
    return names, *(add.reduceat(c[order], first, axis=0) for add, c in zip(_ADDED, columns, strict=True))


def points(rows: DataFrame, key: str, target: str, categorical: Sequence[str], numeric: Sequence[str], trees: int, seed: int, bagged: bool) -> DataFrame:
    """(tree, node, cats, nums, w, s, low, high): total weight and target of the rows with equal features, and their range; runs jobs.

    Each task draws its rows for all trees at once and hands on what it has added up for each point.
    """
    each = rows.select(F.col(key).cast("string").alias("_key"), F.col(target).cast("double").alias("y"), *_features(categorical, numeric))
    named = materialize(each.select("cats", "nums").distinct().select(F.monotonically_increasing_id().alias("point"), "cats", "nums"), "named-points")
    named = _bounded(named, BROADCAST_POINTS)
    hashes = F.array(*(F.xxhash64("_key", F.lit(t), F.lit(seed)) for t in range(trees if bagged else 0))).cast("array<long>")
    each = each.join(named, ["cats", "nums"]).select("point", "y", hashes.alias("hashes"))

    def emitted(held: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        names, w, s, low, high = held
        at, tree = np.nonzero(w)
        for k in range(0, len(at), EMITTED):
            some = at[k : k + EMITTED], tree[k : k + EMITTED]
            without = low[some] > high[some]
            columns = [pa.array(some[1].astype(np.int32)), pa.array(names[some[0]]), pa.array(w[some])]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c[some], mask=without) for c in (s, low, high))], ["tree", "point", "w", "s", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        step = max(1, CELLS // trees)
        for batch in batches:
            for part in (batch.slice(k, step) for k in range(0, batch.num_rows, step)):
                n = part.num_rows
                y = part.column(1).fill_null(0.0).to_numpy(zero_copy_only=False)[:, None]
                w = _drawn(part.column(2).flatten().to_numpy()).reshape(n, trees) if bagged else np.ones((n, trees), np.int64)
                used = (w > 0) & part.column(1).is_valid().to_numpy(zero_copy_only=False)[:, None]
                columns = w.astype(float), np.multiply(w, y, out=np.zeros(w.shape), where=used), np.where(used, y, np.inf), np.where(used, y, -np.inf)
                held.append(_by_point(part.column(0).to_numpy(), columns))
                if sum(h[1].size for h in held) > HELD:
                    held = [_merged(held)]
                    if held[0][1].size > HELD // 2:
                        yield from emitted(held.pop())
        if held:
            yield from emitted(_merged(held))

    added = each.mapInArrow(run, "tree int, point long, w double, s double, low double, high double").groupBy("tree", "point")
    sums = added.agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))
    return sums.join(named, "point").select("tree", F.lit(ROOT).cast("long").alias("node"), "cats", "nums", "w", "s", "low", "high")


def _merged(held: Sequence[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    names, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
    return _by_point(names, columns)


# ---------------------------------------------------------------- splits by Spark


def _gain(left_w: Column, left_s: Column) -> Column:
    off = left_s - left_w * F.col("node_s") / F.col("node_w")
    return off * off * (1 / left_w + F.try_divide(F.lit(1.0), F.col("node_w") - left_w))


def _level(open_points: DataFrame, totals: DataFrame) -> DataFrame:
    """(tree, node, column, text, number): the best split of each node; `totals` has node_w, node_s, n and noise of each."""
    named = open_points.join(_bounded(totals), ["tree", "node"])
    cats = named.select("tree", "node", "w", "s", "node_w", "node_s", F.posexplode("cats").alias("column", "text"))
    cats = cats.groupBy("tree", "node", "column", "text").agg(F.sum("w").alias("lw"), F.sum("s").alias("ls"), F.first("node_w").alias("node_w"), F.first("node_s").alias("node_s"), F.count("*").alias("c"))
    cats = cats.join(_bounded(totals.select("tree", "node", "n")), ["tree", "node"]).where("c < n")
    cats = cats.select("tree", "node", "column", "text", F.lit(None).cast("double").alias("number"), _gain(F.col("lw"), F.col("ls")).alias("gain"))

    nums = named.select("tree", "node", "w", "s", "node_w", "node_s", F.size("cats").alias("first"), F.posexplode("nums").alias("k", "x"))
    nums = nums.withColumn("column", F.col("first") + F.col("k"))
    bins = nums.groupBy("tree", "node", "column").agg(F.count_distinct("x").alias("d"), F.percentile_approx("x", [(k + 0.5) / CANDIDATES for k in range(CANDIDATES)], 10_000).alias("cuts"))
    nums = nums.join(_bounded(bins), ["tree", "node", "column"])
    # The smallest cut that is not below the value; what lies above all cuts stays apart.
    cut = F.when(F.col("d") <= CANDIDATES, F.col("x")).otherwise(F.array_min(F.filter("cuts", lambda q: q >= F.col("x"))))
    nums = nums.groupBy("tree", "node", "column", cut.alias("cut")).agg(F.sum("w").alias("lw"), F.sum("s").alias("ls"), F.min("x").alias("least"), F.max("x").alias("most"), F.first("node_w").alias("node_w"), F.first("node_s").alias("node_s"))
    # At most CANDIDATES + 1 rows per node and column.
    upward = Window.partitionBy("tree", "node", "column").orderBy("least")
    so_far = upward.rowsBetween(Window.unboundedPreceding, 0)
    nums = nums.select("tree", "node", "column", "node_w", "node_s", F.sum("lw").over(so_far).alias("lw"), F.sum("ls").over(so_far).alias("ls"), "most", F.lead("least").over(upward).alias("next"))
    nums = nums.where("next is not null").select("tree", "node", "column", F.lit(None).cast("string").alias("text"), _middle("most", "next").alias("number"), _gain(F.col("lw"), F.col("ls")).alias("gain"))

    candidates = cats.unionByName(nums)
    best = candidates.groupBy("tree", "node").agg(F.max("gain").alias("best"))
    best = best.join(totals.select("tree", "node", "noise"), ["tree", "node"])
    tied = candidates.join(_bounded(best), ["tree", "node"]).where(F.col("gain") >= F.col("best") * (1 - TIE) - F.col("noise"))
    order = F.struct("column", "text", "number")
    chosen = tied.groupBy("tree", "node").agg(F.min(order).alias("c"))
    return materialize(chosen.select("tree", "node", "c.*"), "splits")


def _bounded(small: DataFrame, most: int = BROADCAST_SPLITS) -> DataFrame:
    """Per-node tables are as many rows as there are large nodes: broadcast while that is little."""
    return F.broadcast(small) if small.count() <= most else small


def _middle(a: str, b: str) -> Column:
    return F.when(F.col(a) == -math.inf, F.col(b) - 1).otherwise(F.col(a) + (F.col(b) - F.col(a)) / 2)


def _sent(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """`rows` (tree, node, cats, nums and more) that are in a split node, with the node's child they belong to."""
    moved = rows.join(_bounded(splits), ["tree", "node"])
    left = F.when(F.col("text").isNotNull(), F.element_at("cats", F.col("column") + 1) == F.col("text"))
    left = left.otherwise(F.element_at("nums", F.col("column") - F.size("cats") + 1) <= F.col("number"))
    child = F.xxhash64("tree", "node", left)
    return moved.withColumn("node", child).select(*rows.columns)


# ---------------------------------------------------------------- subtrees in a task


def grow(cats: list[np.ndarray], nums: list[np.ndarray], w: np.ndarray, s: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[str, np.ndarray]:
    """The tree over these points, all nodes of a level at once: split_on (-1 for a leaf), text code, number, left, right, and totals.

    `cats` are codes in the order of their texts.
    """
    node, nodes = np.zeros(len(w), np.int64), 1
    out: dict[str, list[np.ndarray]] = {c: [] for c in ("split_on", "code", "number", "left", "weights", "values", "points", "at_depth")}
    first, depth = 0, 0
    while nodes:
        m = node >= 0
        at = node[m]
        weight, total, count = np.bincount(at, w[m], nodes), np.bincount(at, s[m], nodes), np.bincount(at, minlength=nodes)
        least, most = np.full(nodes, np.inf), np.full(nodes, -np.inf)
        np.minimum.at(least, at, low[m])
        np.maximum.at(most, at, high[m])
        mean = np.where(least == most, least, total / weight)
        candidates = []  # (node, gain, column, code, number)
        for k, codes in enumerate(cats):
            values = codes[m]
            width = int(values.max(initial=0)) + 1
            name, inverse = np.unique(at * width + values, return_inverse=True)
            lw, ls, c = np.bincount(inverse, w[m]), np.bincount(inverse, s[m]), np.bincount(inverse)
            of, code = name // width, name % width
            good = c < count[of]
            candidates.append(_candidates(of[good], lw[good], ls[good], weight, total, k, code[good], None))
        for k, numbers in enumerate(nums):
            order = np.lexsort((numbers[m], at))
            of, x = at[order], numbers[m][order]
            lw, ls = np.cumsum(w[m][order]), np.cumsum(s[m][order])
            start = np.searchsorted(of, np.arange(nodes))
            lw, ls = lw - np.concatenate([[0], lw])[start][of], ls - np.concatenate([[0], ls])[start][of]
            edge = np.flatnonzero((of[1:] == of[:-1]) & (x[1:] > x[:-1]))
            middle = np.where(np.isneginf(x[edge]), x[edge + 1] - 1, x[edge] + (x[edge + 1] - x[edge]) / 2)
            candidates.append(_candidates(of[edge], lw[edge], ls[edge], weight, total, len(cats) + k, None, middle))
        of, gain, column, code, number = (np.concatenate(c) for c in zip(*candidates, strict=True)) if candidates else (np.zeros(0, np.int64),) * 5
        best = np.full(nodes, -np.inf)
        np.maximum.at(best, of, gain)
        noise = weight * (most - least) ** 2 * NOISE
        tied = np.flatnonzero((gain >= best[of] * (1 - TIE) - noise[of]) & (least < most)[of])
        choice = np.full(nodes, len(of))
        np.minimum.at(choice, of[tied], tied)
        split = choice < len(of)
        pick = choice[split]
        numbering = np.cumsum(split) - 1
        for name, found, empty in (("split_on", column, -1), ("code", code, -1), ("number", number, np.nan)):
            values = np.full(nodes, empty, np.float64 if name == "number" else np.int64)
            values[split] = found[pick]
            out[name].append(values)
        out["left"].append(np.where(split, first + nodes + 2 * numbering, -1))
        out["weights"].append(weight)
        out["values"].append(mean)
        out["points"].append(count)
        out["at_depth"].append(np.full(nodes, depth))
        side = np.full(len(w), -1, np.int64)
        here = np.flatnonzero(m)[split[at]]
        of = node[here]
        left = np.zeros(len(here), bool)
        for k in range(len(cats) + len(nums)):
            mine = out["split_on"][depth][of] == k
            if mine.any():
                rows = here[mine]
                left[mine] = cats[k][rows] == out["code"][depth][of[mine]] if k < len(cats) else nums[k - len(cats)][rows] <= out["number"][depth][of[mine]]
        side[here] = 2 * numbering[of] + ~left
        first, node, nodes, depth = first + nodes, side, 2 * int(split.sum()), depth + 1
    return {c: np.concatenate(v) for c, v in out.items()}


def _candidates(of, lw, ls, weight, total, column, code, number) -> tuple[np.ndarray, ...]:
    n = len(of)
    gain = (ls - lw * (total / weight)[of]) ** 2 * (1 / lw + 1 / (weight[of] - lw))
    return of, gain, np.full(n, column), np.full(n, -1) if code is None else code, np.full(n, np.nan) if number is None else number


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """Lists of one length as the rows of an array."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if len(flat) else np.zeros((n, 0))


_SUBTREE = (
    "tree int, node long, depth int, split_on array<int>, text array<string>, number array<double>, left array<int>, "
    "weights array<double>, values array<double>, points array<int>, at_depth array<int>"
)


def _grown(rows: DataFrame) -> DataFrame:
    """One row per node of `rows` (tree, node, depth and the points): the whole tree below it."""

    def run(group: pa.Table) -> pa.Table:
        n = group.num_rows
        texts, numbers = _matrix(group.column("cats"), n), _matrix(group.column("nums"), n).astype(float)
        names, codes = [], []
        for k in range(texts.shape[1]):
            code, name = pd.factorize(texts[:, k], sort=True)
            codes.append(code.astype(np.int64))
            names.append(name)
        found = grow(codes, list(numbers.T), *(group.column(c).to_numpy() for c in ("w", "s", "low", "high")))
        text = [names[k][c] if c >= 0 else None for k, c in zip(found["split_on"].tolist(), found["code"].tolist(), strict=True)]
        lists = [found["split_on"], text, found["number"], found["left"], found["weights"], found["values"], found["points"], found["at_depth"]]
        kinds = [pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
        head = [group.column(c).combine_chunks().slice(0, 1) for c in ("tree", "node", "depth")]
        columns = [*head, *(pa.array([list(x)], pa.list_(kind)) for x, kind in zip(lists, kinds, strict=True))]
        return pa.Table.from_arrays(columns, [f.split()[0] for f in _SUBTREE.split(", ")])

    return _spread(rows, ["tree", "node"]).groupBy("tree", "node").applyInArrow(run, _SUBTREE)


def _spread(rows: DataFrame, name: list[str]) -> DataFrame:
    """Nodes dealt to a set number of tasks: little data is much work here, so tasks must not be merged for being small."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *name)


def fit(rows: DataFrame, key: str, target: str, categorical: Sequence[str], numeric: Sequence[str] = (), trees: int = 100, seed: int = 0, bagged: bool = True, small: int = SMALL) -> Trees:
    """Grow `trees` trees on the rows; runs jobs. Rows without a target must be gone."""
    categorical, numeric = list(categorical), list(numeric)
    active = materialize(points(rows, key, target, categorical, numeric, trees, seed, bagged).withColumn("depth", F.lit(0)), "points")
    levels: list[DataFrame] = []
    done = None
    while True:
        totals = active.groupBy("tree", "node").agg(F.count("*").alias("n"), F.sum("w").alias("node_w"), F.sum("s").alias("node_s"), F.min("low").alias("low"), F.max("high").alias("high"))
        totals = materialize(totals, "node-totals")
        # A large node of one target value is a leaf; its points need not be gathered.
        pure = totals.where((F.col("n") > small) & (F.col("low") == F.col("high")))
        spread = F.col("high") - F.col("low")
        large = totals.where((F.col("n") > small) & (spread > 0)).select("tree", "node", "n", "node_w", "node_s", (F.col("node_w") * spread * spread * NOISE).alias("noise"))
        leaves = pure.select("tree", "node", F.lit(len(levels)).alias("depth"), F.lit(None).cast("array<string>").alias("cats"), F.lit(None).cast("array<double>").alias("nums"), F.col("node_w").alias("w"), F.col("node_s").alias("s"), "low", "high")
        rest = active.join(_bounded(totals.where(F.col("n") > small).select("tree", "node")), ["tree", "node"], "left_anti")
        part = _grown(rest.select("tree", "node", "depth", "cats", "nums", "w", "s", "low", "high")).unionByName(_grown(leaves))
        done = part if done is None else done.unionByName(part)
        if large.isEmpty():
            break
        splits = _level(active, materialize(large, "large-nodes"))
        levels.append(splits)
        active = materialize(_sent(active, splits).withColumn("depth", F.lit(len(levels))), "points")
    return Trees(categorical, numeric, trees, materialize(done, "subtrees"), levels)


# ---------------------------------------------------------------- scoring


def _walk(subtree: dict, texts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The value of the leaf that each row reaches; all rows go down one step at a time."""
    on, left = np.array(subtree["split_on"]), np.array(subtree["left"])
    text, number, values = np.array(subtree["text"], object), np.array(subtree["number"], float), np.array(subtree["values"])
    at = np.zeros(len(texts), np.int64)
    live = np.flatnonzero(on[at] >= 0)
    while len(live):
        nodes = at[live]
        column = on[nodes]
        goes = np.zeros(len(live), bool)
        some = column < texts.shape[1]
        goes[some] = texts[live[some], column[some]] == text[nodes[some]]
        goes[~some] = numbers[live[~some], column[~some] - texts.shape[1]] <= number[nodes[~some]]
        at[live] = left[nodes] + ~goes
        live = live[on[at[live]] >= 0]
    return values[at]


def predict(model: Trees, rows: DataFrame) -> DataFrame:
    """(cats, nums, prediction) of each different combination of features in `rows`: the mean over all trees."""
    distinct = materialize(rows.select(*_features(model.categorical, model.numeric)).distinct(), "combinations")
    number = F.explode(F.sequence(F.lit(0), F.lit(model.trees - 1))).alias("tree")
    active = distinct.select(number, F.lit(ROOT).cast("long").alias("node"), "cats", "nums")
    arrived = None
    for splits in model.levels:
        stay = active.join(_bounded(splits.select("tree", "node")), ["tree", "node"], "left_anti")
        arrived = stay if arrived is None else arrived.unionByName(stay)
        active = materialize(_sent(active, splits), "combinations")
    arrived = materialize(active if arrived is None else arrived.unionByName(active), "arrived")
    portions = arrived.groupBy("tree", "node").agg(F.ceil(F.count("*") / PORTION).cast("int").alias("portions"))
    portions = materialize(portions, "portions")
    dealt = arrived.join(_bounded(portions), ["tree", "node"]).withColumn("portion", F.pmod(F.xxhash64("cats", "nums"), "portions").cast("int"))
    copies = model.subtrees.join(_bounded(portions), ["tree", "node"]).withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))

    def run(found: pa.Table, subtree: pa.Table) -> pa.Table:
        n = found.num_rows
        if not n or not subtree.num_rows:
            return found.select(["cats", "nums"]).slice(0, 0).append_column("value", pa.array([], pa.float64()))
        value = _walk(subtree.slice(0, 1).to_pylist()[0], _matrix(found.column("cats"), n), _matrix(found.column("nums"), n))
        return found.select(["cats", "nums"]).append_column("value", pa.array(value))

    name = ["tree", "node", "portion"]
    found, below = _spread(dealt.select(*name, "cats", "nums"), name), _spread(copies.drop("portions"), name)
    each = found.groupBy(*name).cogroup(below.groupBy(*name)).applyInArrow(run, "cats array<string>, nums array<double>, value double")
    return each.groupBy("cats", "nums").agg(F.avg("value").alias("prediction"))


def with_predictions(model: Trees, rows: DataFrame, to: str) -> DataFrame:
    """`rows` with the forest's prediction in column `to`."""
    found = predict(model, rows).select(F.col("cats").alias("_cats"), F.col("nums").alias("_nums"), F.col("prediction").alias(to))
    cats, nums = _features(model.categorical, model.numeric)
    named = rows.select("*", cats.alias("_cats"), nums.alias("_nums"))
    return named.join(materialize(found, "predictions"), ["_cats", "_nums"], "left").drop("_cats", "_nums")
