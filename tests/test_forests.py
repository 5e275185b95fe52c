import math
import random

import pytest
from pyspark.sql import functions as F

from meterlark.plans import forests


def rows_of(seed, n, numbers=7):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a, b, x, z = rng.choice("pqrst"), rng.choice([None, "u", "v", ""]), rng.randrange(numbers), rng.choice([None, 0.5, 2.0])
        out.append((k, a, b, x, z, 3.0 * (a == "q") + x * (b == "u") + (z or 0) + rng.random()))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b string, x int, z double, y double")


def brute(rows):
    """(weights, values) of all nodes, and a function that predicts, by plain recursion."""
    nodes = []

    def grow(group, depth):
        ys = [r[5] for r in group]
        mean = sum(ys) / len(ys)
        nodes.append((depth, len(group), round(mean, 9)))
        best = []
        if min(ys) < max(ys):
            tests = [(k, v, None) for k in (0, 1) for v in sorted({text(r[1 + k]) for r in group})]
            for k in (0, 1):
                values = sorted({number(r[3 + k]) for r in group})
                tests += [(2 + k, None, p + (q - p) / 2 if p > -math.inf else q - 1) for p, q in zip(values, values[1:], strict=False)]
            for t in tests:
                left = [r[5] for r in group if goes(r, t)]
                if 0 < len(left) < len(ys):
                    right_n = len(ys) - len(left)
                    off = sum(left) - len(left) * mean
                    best.append((off * off * (1 / len(left) + 1 / right_n), t))
        if not best:
            return mean
        top = max(g for g, _ in best)
        chosen = next(t for g, t in best if g >= top * (1 - 1e-9) - 1e-13 * len(ys) * (max(ys) - min(ys)) ** 2)
        return chosen, grow([r for r in group if goes(r, chosen)], depth + 1), grow([r for r in group if not goes(r, chosen)], depth + 1)

    def text(v):
        return "-" if v is None else "+" + v

    def number(v):
        return -math.inf if v is None else float(v)

    def goes(r, t):
        return text(r[1 + t[0]]) == t[1] if t[0] < 2 else number(r[1 + t[0]]) <= t[2]

    tree = grow(rows, 0)

    def predict(r):
        node = tree
        while isinstance(node, tuple):
            node = node[1] if goes(r, node[0]) else node[2]
        return node

    return sorted(nodes), predict


@pytest.mark.parametrize("small", [20_000, 60])
def test_one_tree_equals_plain_recursion(spark, small):
    rows = rows_of(1, 300)
    nodes, predict = brute(rows)
    model = forests.fit(frame(spark, rows).repartition(5), "id", "y", ["a", "b"], ["x", "z"], trees=1, bagged=False, small=small)
    got = model.nodes().collect()
    assert bool(model.levels) == (small < 300)
    if not model.levels:
        assert sorted((r.depth, int(r.weight), round(r.prediction, 9)) for r in got) == nodes
    assert sum(r.is_leaf for r in got) == (len(nodes) + 1) // 2
    others = [*rows, (900, "new", "new", 99, None, 0.0), (901, None, "u", None, 9.0, 0.0)]
    for r in forests.with_predictions(model, frame(spark, others), "p").collect():
        assert r.p == pytest.approx(predict(tuple(r)[:6]), abs=1e-9)


def test_distinct_rows_are_learnt_without_error(spark):
    rng = random.Random(3)
    rows = [(k, f"c{k % 40}", str(k // 40), k, None, rng.gauss(1000, 1e-3)) for k in range(400)]
    df = frame(spark, rows)
    model = forests.fit(df, "id", "y", ["a", "b"], [], trees=1, bagged=False)
    worst = forests.with_predictions(model, df, "p").agg(F.max(F.abs(F.col("p") - F.col("y")))).first()[0]
    assert worst < 1e-9
    assert model.nodes().agg(F.max("depth")).first()[0] > 12


def test_bagged_trees_repeat_for_any_layout_and_size(spark):
    df = frame(spark, rows_of(2, 200))
    runs = []
    for layout, small in ((df.coalesce(1), 20_000), (df.repartition(7), 20_000), (df.orderBy(F.desc("y")), 100)):
        model = forests.fit(layout, "id", "y", ["a", "b"], ["x"], trees=3, seed=4, small=small)
        runs.append({r.id: round(r.p, 9) for r in forests.with_predictions(model, df, "p").collect()})
    assert runs[0] == runs[1] == runs[2]
    drawn = forests.points(df, "id", "y", ["a"], [], 50, 1, True).agg(F.sum("w")).first()[0]
    assert drawn == pytest.approx(50 * 200, rel=0.05)


def test_many_numbers_in_large_nodes(spark):
    rng = random.Random(5)
    rows = [(k, "a", "b", k, None, math.sin(k / 200) + rng.random() / 1000) for k in range(3000)]
    df = frame(spark, rows)
    model = forests.fit(df, "id", "y", ["a"], ["x"], trees=1, bagged=False, small=1500)
    assert model.levels
    assert forests.with_predictions(model, df, "p").agg(F.max(F.abs(F.col("p") - F.col("y")))).first()[0] < 1e-9


def test_one_value_and_no_rows(spark):
    same = frame(spark, [(k, str(k), "u", k, None, 2.0) for k in range(50)])
    for small in (20_000, 10):
        model = forests.fit(same, "id", "y", ["a", "b"], ["x"], trees=2, small=small)
        assert {r.p for r in forests.with_predictions(model, same, "p").collect()} == {2.0}
    none = forests.fit(same.where("false"), "id", "y", ["a"], [], trees=2)
    assert {r.p for r in forests.with_predictions(none, same, "p").collect()} == {None}


@pytest.mark.parametrize("held", [4_000_000, 40])
def test_points_are_added_up_in_the_tasks(spark, monkeypatch, held):
    """Sums over drawn rows, for rows without key or target too, and no row of its own for each drawn row."""
    monkeypatch.setattr(forests, "HELD", held)
    monkeypatch.setattr(forests, "CELLS", 60)
    rows = [(None if k % 9 == 0 else k // 2, *r[1:5], None if k % 7 == 0 or r[1] == "p" else r[5]) for k, r in enumerate(rows_of(6, 120))]
    df = frame(spark, rows).repartition(3)
    found = forests.points(df, "id", "y", ["a", "b"], ["x"], 4, 11, True)
    assert "Generate" not in found._jdf.queryExecution().toString()
    drawn = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("tree"))
    drawn = drawn.select("tree", "a", "b", "x", "y", (F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), "tree", F.lit(11)), 11) / float(1 << 53)).alias("u"))
    want = {}
    for r in drawn.collect():
        w = sum(r.u >= sum(math.exp(-1) / math.factorial(i) for i in range(k)) for k in range(1, 18))
        if w:
            name = r.tree, *("-" if v is None else "+" + v for v in (r.a, r.b)), float(r.x)
            want.setdefault(name, []).append((w, r.y))
    got = {(r.tree, *r.cats, *r.nums): r for r in found.collect()}
    assert got.keys() == want.keys() and {r.node for r in got.values()} == {0}
    for name, each in want.items():
        ys = [y for _, y in each if y is not None]
        r = got[name]
        assert r.w == sum(w for w, _ in each)
        assert (r.low, r.high) == (min(ys, default=None), max(ys, default=None))
        assert r.s == (pytest.approx(sum(w * y for w, y in each if y is not None)) if ys else None)
