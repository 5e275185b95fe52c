import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlark.operators import comoments, profile


def brute(table, a, b):
    kept = [(r[a], r[b]) for r in table if r[a] is not None and r[b] is not None]
    if not kept:
        return None
    if not all(math.isfinite(x) for r in kept for x in r):
        return float("nan")
    x, y = np.array(kept, np.longdouble).T
    if x.min() == x.max() or y.min() == y.max():
        return None
    x, y = x - x.mean(), y - y.mean()
    return float((x @ y) / np.sqrt((x @ x) * (y @ y)))


def assert_equal(got, want):
    assert got.keys() == want.keys()
    for pair, w in want.items():
        g = got[pair]
        assert (g is None) == (w is None), pair
        assert w is None or (math.isnan(w) and math.isnan(g)) or g == pytest.approx(w, abs=1e-9), pair


def test_equals_brute_force_with_gaps_in_any_layout(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.normal(size=400)
    columns = [base, base * 2 + rng.normal(size=400), rng.normal(size=400) * 0.1 + 1e6, np.full(400, 0.1), np.round(base)]
    table = [[None if rng.random() < 0.2 else float(c[k]) for c in columns] for k in range(400)]
    for row in table:
        row.append(0.3 if row[0] is not None else float(rng.normal()))  # constant only where column 0 is present
    names = [f"x{k}" for k in range(6)]
    df = spark.createDataFrame(table, ", ".join(f"{c} double" for c in names))
    want = {(a, b): brute(table, i, j) for i, a in enumerate(names) for j, b in enumerate(names) if i < j}
    assert want[("x0", "x5")] is None and want[("x1", "x5")] is not None
    for parts, chunk in ((1, 1000), (7, 13), (40, 1)):
        monkeypatch.setattr(comoments, "CHUNK", chunk)
        got = {(r[0], r[1]): r[2] for r in profile.correlation_pairs(df.repartition(parts)).collect()}
        assert_equal(got, want)


def test_values_that_are_not_finite_touch_their_own_pairs_only(spark):
    table = [[1.0, 2.0, 5.0], [2.0, 3.0, float("inf")], [float("nan"), None, 1.0], [4.0, 9.0, 2.0]]
    df = spark.createDataFrame(table, "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in profile.correlation_pairs(df).collect()}
    assert_equal(got, {(a, b): brute(table, i, j) for i, j, a, b in ((0, 1, "a", "b"), (0, 2, "a", "c"), (1, 2, "b", "c"))})
    assert got[("a", "b")] == pytest.approx(brute([table[0], table[1], table[3]], 0, 1))


def test_empty_and_single_rows_odd_names_and_no_pairs(spark):
    df = spark.createDataFrame([(1.0, 2)], "`a.b` double, c int")
    for frame in (df, df.where("c > 5")):
        assert [r.correlation for r in comoments.correlations(frame, [("a.b", "c")]).collect()] in ([], [None])
        assert [tuple(r) for r in profile.correlation_pairs(frame).collect()] == [("a.b", "c", None)]
    assert profile.correlation_pairs(df.select("c")).count() == 0


def test_rows_are_not_multiplied(spark):
    df = spark.range(10_000).select(*[(F.col("id") * k % 97).alias(f"c{k}") for k in range(1, 11)]).repartition(4)
    moments = comoments.pair_moments(df, [(f"c{a}", f"c{b}") for a in range(1, 11) for b in range(a + 1, 11)])
    assert moments.count() == 4 * 45
    assert "Generate" not in moments._jdf.queryExecution().executedPlan().toString()
