import math

import pytest
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.operators import features as FE
from meterlark.plans import experiments as E


def predictions(spark, rows):
    return spark.createDataFrame(rows, "actual double, predicted double")


def test_scores(spark):
    row = E.scores(predictions(spark, [(1.0, 2.0), (2.0, 2.0), (6.0, 3.0)])).first()
    assert row["mae"] == pytest.approx(4 / 3)
    assert row["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert row["r2"] == pytest.approx(1 - 10 / 14)


def test_scores_of_a_constant_target(spark):
    assert E.scores(predictions(spark, [(2.0, 2.0), (2.0, 2.0)])).first()["r2"] == 1.0
    assert E.scores(predictions(spark, [(2.0, 2.0), (2.0, 3.0)])).first()["r2"] == 0.0


def test_largest_errors_are_signed_and_sorted(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 4.0), ("b", 9.0, 2.0), ("c", 1.0, 1.0), ("d", 4.0, 1.0)],
        "ewrb_id string, actual double, predicted double",
    )
    got = [(r["ewrb_id"], r["error"]) for r in E.largest_errors(df, 3).collect()]
    assert got == [("b", 7.0), ("a", -3.0), ("d", 3.0)]


def results(spark, rows):
    table = spark.createDataFrame(
        rows, "sequence int, feature_set string, model_name string, mae double, rmse double, r2 double"
    )
    return table.withColumn("label", F.concat("model_name", F.lit(" ("), "feature_set", F.lit(")")))


def test_reports_over_results(spark):
    table = results(
        spark,
        [
            (0, "v1", E.BASELINE, 1.0, 3.0, -0.1),
            (1, "v1", "Forest", 0.5, 2.0, 0.2),
            (100, "v2", E.BASELINE, 1.0 + 1e-9, 3.0, -0.1),
            (101, "v2", "Forest", 0.5, 1.0, 0.1),
            (102, "v2", "Only here", 9.0, 9.0, -9.0),
        ],
    )
    best = {r["metric"]: (r["label"], r["is_primary"]) for r in E.best_by_metric(table).collect()}
    assert best == {
        "mae": ("Forest (v1)", True),
        "rmse": ("Forest (v2)", False),
        "r2": ("Forest (v1)", False),
    }
    compared = E.compare_feature_sets(table).collect()
    assert [r["model_name"] for r in compared] == ["Forest", E.BASELINE]
    assert compared[0]["rmse_change"] == -1.0
    assert E.baseline_consistency(table).first()["consistent"]
    shifted = table.withColumn("mae", F.when(F.col("sequence") == 100, 1.1).otherwise(F.col("mae")))
    assert not E.baseline_consistency(shifted).first()["consistent"]


@pytest.fixture(scope="module")
def frame(spark):
    """A target that is a function of the type, so that models beat the median."""
    rows = []
    for i in range(300):
        kind = ["Office", "Retail", "School"][i % 3]
        city = ["Ottawa", "Toronto"][i % 2]
        cert = "LEED" if i % 10 == 0 else None
        rows.append((str(i), city, "K1A", kind, kind, kind, kind, cert, 1.0 + 3 * (i % 3) + (i % 2)))
    df = spark.createDataFrame(
        rows,
        "ewrb_id string, city string, postal_code string, primary_property_type string, "
        "self_property_type string, largest_property_type string, all_property_types string, "
        "third_party_certification string, site_eui_gj_m2 double",
    )
    return FE.prepare(df)


@pytest.fixture(scope="module")
def grid(frame):
    return E.run_grid(frame, E.Forest(trees=5, depth=6)).cache()


def test_grid_runs_every_model_on_the_same_test_rows(frame, grid):
    n_test = frame.where("is_test").count()
    table = E.results_table(grid, E.Forest(trees=5, depth=6)).collect()
    assert {(r["trees"], r["depth"]) for r in table if "Forest" in r["model_name"]} == {(5, 6)}
    assert [r["feature_set"] for r in table] == ["v1"] * 5 + ["v2"] * 5
    assert {r["n"] for r in table} == {n_test}
    assert len({r["model_name"] for r in table}) == 5
    scores = {(r["feature_set"], r["model_name"]): r["mae"] for r in table}
    for feature_set in ("v1", "v2"):
        assert scores[feature_set, "Linear Regression"] < 1e-3
        assert scores[feature_set, "Random Forest"] < 0.1
        assert scores[feature_set, "Random Forest log1p"] < 0.1
        assert scores[feature_set, E.BASELINE] > 1.0


def test_grid_reports(grid):
    table = E.results_table(grid)
    assert E.baseline_consistency(table).first()["consistent"]
    assert E.compare_feature_sets(table).count() == 5
    worst = E.errors_of_best(grid, table, 3).collect()
    assert len(worst) == 3
    assert {S.KEY, "city", "actual", "predicted", "error", "absolute_error"} <= set(worst[0].asDict())


def test_forest_repeats_with_its_seed(frame):
    runs = [
        E.results_table(
            E.run_grid(frame, E.Forest(trees=3, depth=4), ["v1"], only=["Random Forest"])
        ).collect()
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_forest_does_not_depend_on_the_layout_of_its_rows(frame):
    """Any number of input parts and any row order give the same predictions."""
    layouts = [frame.coalesce(1), frame.repartition(3), frame.repartition(8), frame.orderBy(F.rand(5)).repartition(5)]
    runs = [
        sorted(
            (r[S.KEY], r["predicted"])
            for r in E.run_grid(layout, E.Forest(trees=3, depth=4), ["v1"], only=["Random Forest"])
            .where("model_name = 'Random Forest'")
            .collect()
        )
        for layout in layouts
    ]
    assert runs[0] and all(run == runs[0] for run in runs)


def test_linear_models_predict_the_means_of_their_categories(frame):
    """With one category the predictions are its training means; with log1p, expm1 of the mean log."""
    single = frame.withColumns({c: F.lit("x") for c in FE.CATEGORICAL if c != "city"})
    wanted = {
        r["city"]: (r["m"], r["g"])
        for r in single.where("not is_test")
        .groupBy("city")
        .agg(F.avg(S.TARGET).alias("m"), F.expm1(F.avg(F.log1p(S.TARGET))).alias("g"))
        .collect()
    }
    names = ["Linear Regression", "Linear Regression log1p"]
    for r in E.run_grid(single, E.Forest(trees=1, depth=1), ["v1"], only=names).collect():
        if r["model_name"] in names:
            assert r["predicted"] == pytest.approx(wanted[r["city"]][names.index(r["model_name"])], rel=1e-4)


def test_forests_stay_inside_the_range_of_their_training_target(frame):
    low, high = frame.where("not is_test").agg(F.min(S.TARGET), F.max(S.TARGET)).first()
    grid = E.run_grid(frame, E.Forest(trees=4, depth=30), ["v2"], only=["Random Forest", "Random Forest log1p"])
    for r in grid.where("model_name like 'Random%'").collect():
        assert low - 1e-9 <= r["predicted"] <= high + 1e-9


def test_median_baseline_uses_training_rows(frame):
    middle = {r["predicted"] for r in E.median_predictions(frame).select("predicted").collect()}
    train = frame.where("not is_test").selectExpr("median(site_eui_gj_m2)").first()[0]
    assert middle == {train}
