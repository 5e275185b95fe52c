import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterlark.operators import features, quantiles, ranking
from meterlark.operators.quantiles import exact_quantiles
from meterlark.operators.ranking import rank_within, top_k, top_k_matched
from tests.conftest import pairs

PROBABILITIES = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99, "high": 1.0}


def skewed(n=3000, seed=1):
    """A third of the rows in one group, a third of those with one value, and huge outliers."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else draw.choice(["a", "b", None])
        value = draw.choice([0.0, draw.lognormvariate(0, 3), -draw.random(), None])
        rows.append((i, group, value if i % 500 else 1e12 * (i + 1)))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "id int, g string, x double").repartition(6).cache()


def by_name(df):
    return {r["g"]: r for r in df.collect()}


def test_quantile_literal(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "x double")
    row = exact_quantiles(df, "x", PROBABILITIES).first()
    assert tuple(row) == (4, 1.0, 1.75, 3.0, 5.0, pytest.approx(7.88), 8.0)


@pytest.mark.parametrize("max_rows", [20, 400])
def test_narrowed_quantiles_equal_the_direct_ones(frame, max_rows):
    direct = exact_quantiles(frame, "x", PROBABILITIES, ["g"])
    narrowed = exact_quantiles(frame, "x", PROBABILITIES, ["g"], max_rows=max_rows)
    assert by_name(narrowed) == by_name(direct)
    whole = exact_quantiles(frame, "x", PROBABILITIES).first()
    assert exact_quantiles(frame, "x", PROBABILITIES, max_rows=max_rows).first() == whole


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(exact_quantiles(df, "x", {"m": 0.5}).first()) == (0, None)


@pytest.mark.parametrize("max_rows", [1, 2, 1000])
def test_infinities_and_nan_have_their_ranks(spark, max_rows):
    inf, nan = float("inf"), float("nan")
    values = [("a", v) for v in (1.0, 2.0, 3.0, inf, -inf)] + [("b", inf), ("b", inf), ("c", nan), ("c", 1.0), ("d", -inf)]
    df = spark.createDataFrame(values, "g string, x double")
    got = by_name(exact_quantiles(df, "x", {"low": 0.0, "middle": 0.5, "high": 1.0}, ["g"], max_rows=max_rows))
    assert tuple(got["a"])[1:] == (5, -inf, 2.0, inf)
    assert tuple(got["b"])[1:] == (2, inf, inf, inf)
    assert got["c"]["low"] == 1.0 and math.isnan(got["c"]["high"])
    assert tuple(got["d"])[1:] == (1, -inf, -inf, -inf)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False, width=64) | st.sampled_from([0.0, 1.0]),
        min_size=3,
        max_size=60,
    )
)
def test_narrowing_holds_for_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").coalesce(2)
    wanted = {"low": 0.0, "high": 1.0, "middle": 0.5}
    narrowed = exact_quantiles(df, "x", wanted, max_rows=1).first()
    assert narrowed == exact_quantiles(df, "x", wanted).first()


@pytest.mark.parametrize("max_rows", [7, 100])
def test_split_rank_equals_the_window(frame, max_rows):
    known = frame.where(F.col("x").isNotNull())
    direct = rank_within(known, "g", "x", "r")
    assert pairs(rank_within(known, "g", "x", "r", max_rows)) == pairs(direct)


def test_ranges_that_stay_too_large_are_cut_again(frame, monkeypatch):
    monkeypatch.setattr(ranking, "MAX_CUTS", 3)
    known = frame.where(F.col("x").isNotNull())
    assert pairs(rank_within(known, "g", "x", "r", 40)) == pairs(rank_within(known, "g", "x", "r"))


def test_rank_leaves_gaps_after_ties(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 3.0), ("a", 1.0), ("b", 2.0)], "g string, x double")
    assert pairs(rank_within(df, "g", "x", "r")) == [
        ("a", 1.0, 3),
        ("a", 3.0, 1),
        ("a", 3.0, 1),
        ("b", 2.0, 1),
    ]


def test_top_k_null_order_and_ties(spark):
    df = spark.createDataFrame([("a", None), ("c", 2.0), ("b", 2.0), ("d", 1.0)], "k string, x double")
    assert [r["k"] for r in top_k(df, "x", 3, ["k"]).collect()] == ["a", "b", "c"]
    assert [r["k"] for r in top_k(df, "x", 3, ["k"], "last").collect()] == ["b", "c", "d"]


@pytest.mark.parametrize("candidates", [3, 1000])
def test_top_k_of_a_join_when_many_facts_have_no_parent(spark, candidates):
    facts = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("x"))
    parents = facts.where("x < 50").select("k", F.lit("p").alias("city"))
    got = top_k_matched(facts, parents, "k", "x", 3, ["k"], "last", candidates)
    assert [r["k"] for r in got.collect()] == ["49", "48", "47"]


@pytest.mark.parametrize("n", [1, 4, 97, 1000])
def test_exact_split_has_the_exact_size(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    direct = features.exact_split(df, "k")
    assert direct.where("is_test").count() == -(-n // 5)
    counted = features.exact_split(df.repartition(5), "k", max_rows=2)
    assert pairs(counted) == pairs(direct)


@pytest.mark.parametrize(("size", "grid"), [(8, 4), (8, 64), (64, 16)])
def test_quantiles_from_rough_sketches(frame, monkeypatch, size, grid):
    """Brackets of a rough sketch hold more rows, and fewer of them hold their rank; the results are the same."""
    want = by_name(exact_quantiles(frame, "x", PROBABILITIES, ["g"]))
    monkeypatch.setattr(quantiles, "SKETCH_SIZE", size)
    monkeypatch.setattr(quantiles, "GRID", grid)
    assert by_name(exact_quantiles(frame, "x", PROBABILITIES, ["g"])) == want


def test_a_bracket_that_misses_its_rank_is_searched(frame, monkeypatch):
    """Grids of another column's quantiles mislead all ranks but the ends."""
    want = by_name(exact_quantiles(frame, "x", PROBABILITIES, ["g"]))
    right = quantiles._sketched

    def misled(rows, by):
        shifted = F.transform("_grid", lambda q: q * 0 + F.col("_hi"))
        return right(rows, by).withColumn("_grid", shifted)

    monkeypatch.setattr(quantiles, "_sketched", misled)
    assert by_name(exact_quantiles(frame, "x", PROBABILITIES, ["g"])) == want


def test_quantiles_equal_sorted_lists(spark):
    draw = random.Random(5)
    rows = [(draw.choice([None, "a", "b"]), draw.choice([draw.gauss(0, 1), float(draw.randint(0, 3))])) for _ in range(20000)]
    got = by_name(exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", PROBABILITIES, ["g"]))
    for group in (None, "a", "b"):
        values = sorted(x for g, x in rows if g == group)
        assert got[group]["n"] == len(values)
        for name, p in PROBABILITIES.items():
            at = p * (len(values) - 1)
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got[group][name] == pytest.approx(low + (high - low) * (at - math.floor(at)), abs=1e-12)


def test_two_reads_of_the_rows(spark, tmp_path):
    """Whatever the size of a group, its rows are read by the sketch and by the counts only."""
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(300000).select((F.rand(1) * 1e6).alias("x")).mapInArrow(counted, "x double")
    assert exact_quantiles(df, "x", {"m": 0.5}).first()["n"] == 300000
    assert reads.value == 600000
