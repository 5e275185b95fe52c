"""Regression experiments: fit a grid of models, score them, and explain their errors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions.scalar import is_close
from meterlark.operators import features as FE
from meterlark.operators.quantiles import exact_quantiles
from meterlark.plans import forests, leastsquares
from meterlark.session import materialize

BASELINE = "Median Baseline"
METRICS = ("mae", "rmse", "r2")
CONTEXT = [
    S.KEY,
    "city",
    "primary_property_type",
    "self_property_type",
    "largest_property_type",
    "postal_code",
]


@dataclass(frozen=True)
class Forest:
    """Forest settings. Without a depth the trees grow until every leaf is pure (`plans.forests`).

    With a depth (up to 30) they are MLlib's and stop there; `parts` is then how many parts the
    training rows are cut into, by key and in key order, since the draws follow rows and parts.
    """

    depth: int | None = None
    trees: int = 100
    seed: int = FE.SEED
    memory_mb: int = 512
    parts: int = 8


def median_of(df: DataFrame, target: str = S.TARGET) -> Column:
    """Median of the target as a scalar subquery."""
    return exact_quantiles(df, target, {"median": 0.5}).select("median").scalar()


def median_predictions(frame: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Test rows with the training median as prediction."""
    middle = median_of(frame.where(~F.col("is_test")), target)
    test = frame.where(F.col("is_test"))
    return test.withColumns({"actual": F.col(target), "predicted": middle})


def scores(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, root mean squared error and R2 on the original scale, in one pass.

    When the actual values are all equal, R2 is 1 for perfect predictions and else 0.
    """
    error = F.col("actual") - F.col("predicted")
    summed = predictions.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error * error).alias("_mse"),
        F.var_pop("actual").alias("_spread"),
    )
    constant = F.when(F.col("_mse") == 0, 1.0).otherwise(0.0)
    r2 = F.when(F.col("_spread") == 0, constant).otherwise(
        1 - F.try_divide(F.col("_mse"), F.col("_spread"))
    )
    return summed.select(*by, "n", "mae", "rmse", r2.alias("r2"))


def largest_errors(
    predictions: DataFrame, k: int = 10, key: str = S.KEY, context: Sequence[str] = CONTEXT
) -> DataFrame:
    """The `k` worst predictions with their context; a positive error is an underprediction."""
    error = F.col("actual") - F.col("predicted")
    present = [c for c in context if c in predictions.columns]
    return (
        predictions.select(*present, "actual", "predicted", error.alias("error"))
        .withColumn("absolute_error", F.abs("error"))
        .orderBy(F.col("absolute_error").desc_nulls_last(), F.col(key).asc())
        .limit(k)
    )


LINEAR = {"Linear Regression": False, "Linear Regression log1p": True}
FORESTS = {"Random Forest": False, "Random Forest log1p": True}
#: Order of the models, with whether they learn log1p of the target.
MODELS = [("Linear Regression", False), ("Random Forest", False), ("Linear Regression log1p", True), ("Random Forest log1p", True)]


def _limited_trees(forest: Forest) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features",
        numTrees=forest.trees,
        maxDepth=forest.depth,
        minInstancesPerNode=1,
        featureSubsetStrategy="all",
        maxMemoryInMB=forest.memory_mb,
        seed=forest.seed,
    )


def spread(df: DataFrame, key: str, parts: int) -> DataFrame:
    """The rows in `parts` parts by the hash of the key, in key order: the same for any layout."""
    return df.repartition(parts, key).sortWithinPartitions(key)


@dataclass(frozen=True)
class FittedSet:
    """The models fitted on the training rows of one feature set."""

    name: str
    linear: leastsquares.LeastSquares | None
    grown: dict[str, forests.Trees]
    limited: dict[str, object]
    encoder: PipelineModel | None
    depth: int | None


def fit_feature_set(
    frame: DataFrame,
    feature_set: str,
    forest: Forest,
    target: str = S.TARGET,
    only: Sequence[str] | None = None,
) -> FittedSet:
    """Fit each model on the training rows."""
    chosen = FE.FEATURE_SETS[feature_set]
    columns = chosen["categorical"], chosen["numeric"]
    train = FE.select_features(frame, feature_set, target, [S.KEY, "is_test"]).where(~F.col("is_test"))
    wanted = [name for name, _ in MODELS if only is None or name in only]
    linear = None
    if any(name in LINEAR for name in wanted):
        linear = leastsquares.fit(train, [F.col(target), F.log1p(target)], *columns)
    trees = {name: FORESTS[name] for name in wanted if name in FORESTS}
    if forest.depth is None:
        grown = {}
        for name, log in trees.items():
            rows = train.withColumn("_y", F.log1p(target) if log else F.col(target))
            grown[name] = forests.fit(rows, S.KEY, "_y", *columns, trees=forest.trees, seed=forest.seed)
        return FittedSet(feature_set, linear, grown, {}, None, None)
    rows = spread(train, S.KEY, forest.parts)
    encoder = FE.build_encoder(*columns).fit(rows)
    encoded = encoder.transform(rows).select("features", F.col(target).alias("y"), F.log1p(target).alias("log_y")).persist()
    try:
        limited = {name: _limited_trees(forest).setLabelCol("log_y" if log else "y").fit(encoded) for name, log in trees.items()}
    finally:
        encoded.unpersist()
    return FittedSet(feature_set, linear, {}, limited, encoder, forest.depth)


def predict(
    fitted: FittedSet, frame: DataFrame, middle: Column, sequence: int = 0, target: str = S.TARGET
) -> DataFrame:
    """Predictions of the baseline and every fitted model for the test rows, one row per model.

    `middle` is the training median; `depth` is that of the deepest tree of a forest.
    """
    test = frame.where(F.col("is_test"))
    if fitted.linear:
        test = fitted.linear.with_predictions(test, list(LINEAR))
    for name, model in fitted.grown.items():
        test = forests.with_predictions(model, test, name)
    if fitted.limited:
        test = fitted.encoder.transform(test)
        for name, model in fitted.limited.items():
            test = model.setPredictionCol(name).transform(test)
    entries = [(BASELINE, middle, None)]
    for name, log in MODELS:
        if name in test.columns:
            depth = fitted.depth if name in fitted.limited else None
            if name in fitted.grown:
                depth = fitted.grown[name].nodes().agg(F.max("depth")).first()[0]
            entries.append((name, F.expm1(F.col(name)) if log else F.col(name), depth))
    per_model = F.array(
        *[
            F.struct(
                F.lit(sequence * 100 + i).alias("sequence"),
                F.lit(name).alias("model_name"),
                value.alias("predicted"),
                F.lit(depth).cast("int").alias("depth"),
            )
            for i, (name, value, depth) in enumerate(entries)
        ]
    )
    return test.select(
        F.lit(fitted.name).alias("feature_set"),
        *[c for c in CONTEXT if c in frame.columns],
        F.col(target).alias("actual"),
        F.inline(per_model),
    )


def run_grid(
    frame: DataFrame,
    forest: Forest,
    feature_sets: Sequence[str] = tuple(FE.FEATURE_SETS),
    target: str = S.TARGET,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Test predictions of every model on every feature set.

    `frame` comes from `prepare` and is written once. Feature sets share its split, so
    differences in the scores come from the features and models.
    """
    frame = materialize(frame, "experiments")
    middle = median_of(frame.where(~F.col("is_test")), target)
    grid = None
    for i, name in enumerate(feature_sets):
        fitted = fit_feature_set(frame, name, forest, target, only)
        part = predict(fitted, frame, middle, i, target)
        grid = part if grid is None else grid.unionByName(part)
    return grid


def results_table(predictions: DataFrame, forest: Forest | None = None) -> DataFrame:
    """Scores per experiment, in the order the experiments ran, with the trees and depth of forests if `forest` is given."""
    names = ["sequence", "feature_set", "model_name"]
    table = scores(predictions, names)
    label = F.concat("model_name", F.lit(" ("), "feature_set", F.lit(")"))
    if forest:
        depths = predictions.groupBy(*names).agg(F.max("depth").alias("depth"))
        trees = F.when(F.col("model_name").isin(list(FORESTS)), forest.trees).alias("trees")
        # One row per experiment.
        table = table.join(F.broadcast(depths), names).select(*table.columns, trees, "depth")
    return table.withColumn("label", label).orderBy("sequence")


def best_by_metric(results: DataFrame, primary: str = "mae") -> DataFrame:
    """Best experiment per metric; the earlier experiment wins a tie."""
    picks = []
    for metric in METRICS:
        better = -F.col(metric) if metric == "r2" else F.col(metric)
        order = F.struct(better, F.col("sequence"))
        picks.append(
            F.struct(
                F.lit(metric).alias("metric"),
                F.min_by("label", order).alias("label"),
                F.min_by(metric, order).alias("value"),
                F.lit(metric == primary).alias("is_primary"),
            )
        )
    return results.agg(F.array(*picks).alias("_all")).select(F.inline("_all"))


def compare_feature_sets(results: DataFrame, before: str = "v1", after: str = "v2") -> DataFrame:
    """Scores of each model on both feature sets; models that ran on only one are left out."""
    def side(name: str) -> list[Column]:
        return [
            F.max(F.when(F.col("feature_set") == name, F.col(m))).alias(f"{m}_{name}") for m in METRICS
        ]

    both = results.where(F.col("feature_set").isin(before, after)).groupBy("model_name").agg(
        F.count_distinct("feature_set").alias("_sets"), *side(before), *side(after)
    )
    changes = [
        (F.col(f"{m}_{after}") - F.col(f"{m}_{before}")).alias(f"{m}_change") for m in METRICS
    ]
    columns = [f"{m}_{name}" for m in METRICS for name in (before, after)]
    return both.where(F.col("_sets") == 2).select("model_name", *columns, *changes).orderBy("model_name")


def baseline_consistency(results: DataFrame, before: str = "v1", after: str = "v2") -> DataFrame:
    """One row: whether the baseline scored the same on both feature sets, as one split implies."""
    compared = compare_feature_sets(results.where(F.col("model_name") == BASELINE), before, after)
    same = F.lit(True)
    for m in METRICS:
        same = same & is_close(F.col(f"{m}_{before}"), F.col(f"{m}_{after}"))
    return compared.select(
        "model_name", *[f"{m}_{name}" for m in METRICS for name in (before, after)], same.alias("consistent")
    )


def errors_of_best(predictions: DataFrame, results: DataFrame, k: int = 10) -> DataFrame:
    """Worst predictions of the experiment with the smallest mean absolute error."""
    winner = results.agg(F.min_by("sequence", F.struct("mae", "sequence"))).scalar()
    return largest_errors(predictions.where(F.col("sequence") == winner), k)
