import math

import pytest
from pyspark.sql import functions as F

from meterlark.operators import distribution, profile, ranking


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_shape_and_missing(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 1.0, "b")], "i int, x double, t string")
    assert rows(profile.shape_and_types(df)) == [
        ("i", 1, "int", 3, 3),
        ("x", 2, "double", 3, 3),
        ("t", 3, "string", 3, 3),
    ]
    assert rows(profile.missing_values(df)) == [("x", 2, 66.7), ("t", 1, 33.3)]
    assert rows(profile.missing_in(df, "i")) == [("i", 0, 0.0)]
    assert rows(profile.missing_values(df.limit(0))) == []


def test_describe_with_few_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "x double")
    n, mean, std, low, q1, median, q3, high = rows(profile.describe(df, "x"))[0]
    assert (n, mean, low, q1, median, q3, high) == (4, 3.75, 1.0, 1.75, 3.0, 5.0, 8.0)
    assert std == pytest.approx(3.095696)
    assert rows(profile.describe(df.where("x = 1"), "x"))[0][2] is None


def test_correlation_ignores_incomplete_rows_and_constant_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, 1.0), (3.0, 6.0, 7.0, None), (4.0, None, 7.0, None)],
        "a double, b double, c double, d double",
    )
    pairs = {(a, b): r for a, b, r in rows(profile.correlation_pairs(df))}
    assert len(pairs) == 6
    assert pairs[("a", "b")] == pytest.approx(1.0)
    assert all(r is None for p, r in pairs.items() if p != ("a", "b"))


def test_correlations_sort_by_strength(spark):
    df = spark.range(20).select(
        F.col("id").cast("double").alias("y"),
        (-F.col("id")).alias("inverse"),
        (F.col("id") % 3).alias("weak"),
        F.lit(1).alias("flat"),
        F.col("id").cast("string").alias("text"),
    )
    got = rows(profile.target_correlations(df, "y", ["text"]))
    assert [r[0] for r in got] == ["inverse", "weak", "flat"]
    assert got[0][1] == pytest.approx(-1.0) and got[2][1] is None
    assert [r[0] for r in rows(profile.watchlist_correlations(df, "y", ["weak", "absent"]))] == ["weak"]


def test_match_rates_count_null_as_different(spark):
    df = spark.createDataFrame(
        [("a", "a", "a"), ("a", "a", "b"), (None, None, None), ("a", None, "a")], "p string, s string, g string"
    )
    got = {label: pct for label, pct, _ in rows(profile.match_rates(df, ["p", "s", "g"]))}
    assert got == {"p = s": 50.0, "p = g": 50.0, "s = g": 25.0, "all": 25.0}


def test_text_profile_reports_the_first_longest(spark):
    df = spark.createDataFrame([(3, "bbb", None), (1, "a", None), (2, "ccc", None)], "i int, t string, u string")
    got = rows(profile.text_profile(df.repartition(3), ["t", "u"], "i"))
    assert got == [("t", 3, 2, "ccc", 0), ("u", None, None, None, 3)]


def test_outliers(spark):
    values = [(str(i), float(i)) for i in range(1, 10)] + [("x", 100.0), ("y", -50.0), ("z", None)]
    df = spark.createDataFrame(values, "k string, x double")
    n, low, high, count, pct = rows(profile.outlier_summary(df, "x"))[0]
    assert (n, count) == (11, 2) and pct == pytest.approx(200 / 11)
    assert (low, high) == (2.5 - 7.5, 7.5 + 7.5) or low < high
    assert sorted(r[0] for r in rows(profile.outliers(df, "x", ["k"]))) == ["x", "y"]
    assert rows(profile.largest_outliers(df, "x", ["k"], 1)) == [("x", 100.0)]
    assert rows(profile.outlier_summary(df, "x", max_rows=2)) == [(n, low, high, count, pct)]


def test_counts(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "t string")
    assert rows(ranking.category_counts(df, "t")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(ranking.top_categories(df, "t", 1)) == [("a", 2)]
    assert rows(ranking.value_counts(df, "t")) == [("a", 2), ("b", 2), ("c", 1)]


def histogram(df, make, **kwargs):
    return [(r["bin"], r["n"]) for r in make(df, "x", **kwargs).orderBy("bin").collect()]


def test_equal_width_histogram_agrees_with_numpy(spark):
    numpy = pytest.importorskip("numpy")
    values = [float(v) for v in numpy.random.default_rng(3).lognormal(0, 2, 2000)]
    values += [v / 10 for v in range(41)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(4)
    expected, edges = numpy.histogram(values, bins=40)
    got = distribution.equal_width_histogram(df, "x").orderBy("bin").collect()
    assert [r["n"] for r in got] == list(expected)
    assert [r["bin_start"] for r in got] + [got[-1]["bin_end"]] == pytest.approx(list(edges))


def test_histogram_of_values_on_the_edges(spark):
    numpy = pytest.importorskip("numpy")
    values = [v / 10 for v in range(11)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    expected = list(enumerate(numpy.histogram(values, bins=10)[0]))
    assert histogram(df, distribution.equal_width_histogram, bins=10) == expected
    whole = spark.range(11).selectExpr("cast(id as double) as x")
    assert histogram(whole, distribution.equal_width_histogram, bins=10) == [(i, 1) for i in range(9)] + [(9, 2)]


def test_histogram_of_one_value_and_of_none(spark):
    one = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert histogram(one, distribution.equal_width_histogram, bins=4) == [(0, 0), (1, 0), (2, 2), (3, 0)]
    assert histogram(one, distribution.log_histogram, edges=4) == [(0, 0), (1, 0), (2, 2)]
    none = spark.createDataFrame([(None,)], "x double")
    assert histogram(none, distribution.equal_width_histogram, bins=3) == [(0, 0), (1, 0), (2, 0)]


def test_log_histogram_keeps_the_largest_and_drops_non_positive(spark):
    values = [0.0, -1.0, 0.3, 2.0, 47000.0, 46999.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = histogram(df, distribution.log_histogram)
    assert len(got) == 39 and sum(n for _, n in got) == 4
    assert got[-1] == (38, 2) and got[0] == (0, 1)


def test_box_stats(spark):
    values = [("a", float(v)) for v in (0, 1, 2, 3, 4, 5, 6, 7, 100)]
    values += [("b", 5.0), ("b", None), ("b", 0.0), ("c", 1.0), (None, 1.0)] + [("d", None)] * 3
    df = spark.createDataFrame(values, "t string, x double").withColumn("k", F.monotonically_increasing_id())
    got = {r["t"]: r.asDict() for r in distribution.box_stats(df, "t", "x", 3, positive_only=True).collect()}
    assert set(got) == {"a", "b", "d"}
    assert got["a"] == {
        "t": "a",
        "n_in_category": 9,
        "n": 8,
        "q1": 2.75,
        "median": 4.5,
        "q3": 6.25,
        "whisker_low": 1.0,
        "whisker_high": 7.0,
        "n_fliers": 1,
    }
    assert (got["b"]["n"], got["b"]["n_in_category"]) == (1, 3)
    assert (got["d"]["n"], got["d"]["median"], got["d"]["n_fliers"]) == (0, None, 0)
    fliers = distribution.box_fliers(df, "t", "x", 3, "k", positive_only=True)
    assert [(r["t"], r["x"]) for r in fliers.collect()] == [("a", 100.0)]
    small = distribution.box_stats(df, "t", "x", 3, positive_only=True, max_rows=2)
    assert {r["t"]: r.asDict() for r in small.collect()} == got


def test_whiskers_never_end_inside_the_box(spark):
    # Quartiles 0, 0 and 2.5 by interpolation; no value lies between 2.5 and the fence.
    df = spark.createDataFrame([("a", v) for v in (0.0, 0.0, 0.0, 10.0)], "t string, x double")
    row = distribution.box_stats(df, "t", "x", 1).first()
    assert (row["q3"], row["whisker_high"], row["n_fliers"]) == (2.5, 2.5, 1)
    assert math.isclose(row["whisker_low"], 0.0)
