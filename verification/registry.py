"""Every registered query: the library run over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions.joins import join_frequent
from meterlark.operators import clean, distribution, features, profile, quality, ranking
from meterlark.operators.quantiles import exact_quantiles
from meterlark.plans import analysis, dataset, experiments, forests, leastsquares
from meterlark.session import fresh_path, materialize
from meterlark.sources import files, load
from verification import views

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that the test tables take the path for groups too large for one task.
SPLIT_ROWS = 150
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
LINE_PAYLOAD = ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
TIGHT_LIMITS = {"ewrb_id": 3, "city": 8, "primary_property_type": 9}
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Floating sums differ in their last digits with the order of the rows."""
    return df.select(
        *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes]
    )


def tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return views.buildings(spark, sf_dir), views.energy(spark, sf_dir)


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset.modeling_dataset(*tables(spark, sf_dir))


def model_columns(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the modeling dataset, written once for queries that read them several times."""
    return materialize(model_frame(spark, sf_dir).select(*columns), "model")


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.prepare(model_frame(spark, sf_dir))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_ORDER, *LINE_PAYLOAD)


# Analysis queries


@register
def q01_mean_eui_by_type(spark, sf_dir):
    return analysis.mean_eui_by_type(*tables(spark, sf_dir))


@register
def q02_top_ghg_buildings(spark, sf_dir):
    return analysis.top_ghg_buildings(*tables(spark, sf_dir))


@register
def q02b_top_ghg_nulls_last(spark, sf_dir):
    return analysis.top_ghg_buildings(*tables(spark, sf_dir), nulls="last")


@register
def q03_mean_water_by_city(spark, sf_dir):
    return analysis.mean_water_by_city(*tables(spark, sf_dir))


@register
def q04_buildings_by_type(spark, sf_dir):
    return analysis.buildings_by_type(views.buildings(spark, sf_dir))


@register
def q05_mean_score_by_type(spark, sf_dir):
    return analysis.mean_score_by_type(*tables(spark, sf_dir))


@register
def q06_weather_gap(spark, sf_dir):
    return analysis.weather_gap(*tables(spark, sf_dir))


@register
def q07_missing_readings(spark, sf_dir):
    return analysis.missing_readings(*tables(spark, sf_dir))


@register
def q08_efficiency_tiers(spark, sf_dir):
    return analysis.efficiency_tiers(*tables(spark, sf_dir))


@register
def q09_cities_above_mean(spark, sf_dir):
    return analysis.cities_above_mean(*tables(spark, sf_dir))


@register
def q10_rank_in_type(spark, sf_dir):
    return analysis.rank_in_type(*tables(spark, sf_dir))


@register
def q10b_rank_in_large_type(spark, sf_dir):
    return analysis.rank_in_type(*tables(spark, sf_dir), max_rows=SPLIT_ROWS)


# Sources, sinks and loading


@register
def scan_buildings(spark, sf_dir):
    return files.scan(views.buildings(spark, sf_dir), S.BUILDINGS.names)


@register
def scan_energy(spark, sf_dir):
    return files.scan(views.energy(spark, sf_dir), S.ENERGY.names)


@register
def sql_text(spark, sf_dir):
    buildings, energy = tables(spark, sf_dir)
    text = """
        SELECT b.city, count(*) AS n_rows, max(e.reporting_year) AS last_year
        FROM {buildings} b JOIN {energy} e ON b.ewrb_id = e.ewrb_id
        GROUP BY b.city ORDER BY n_rows DESC, b.city
    """
    return files.run_sql(spark, text, buildings=buildings, energy=energy)


@register
def parquet_round_trip(spark, sf_dir):
    path = fresh_path(spark, "energy")
    files.write_table(views.energy(spark, sf_dir), path, partition_by=S.YEAR)
    return files.read_table(spark, path, S.ENERGY).select(*S.ENERGY.names)


@register
def raw_parquet_clean(spark, sf_dir):
    """The raw sheet written as Parquet text, read back, and cleaned."""
    path = fresh_path(spark, "raw-parquet")
    sheet = views.raw(spark, sf_dir).drop("sheet_row")
    files.write_table(sheet, path)
    return clean.clean_energy(files.read_raw_parquet(spark, path, sheet.columns), year=2024)


@register
def csv_export(spark, sf_dir):
    path = fresh_path(spark, "model-csv")
    frame = model_frame(spark, sf_dir)
    files.write_csv(frame, path)
    return files.read_csv(spark, path, frame.schema)


@register
def raw_csv_clean(spark, sf_dir):
    """The raw sheet written as CSV, read back as text, and cleaned."""
    path = fresh_path(spark, "raw-csv")
    sheet = views.raw(spark, sf_dir).drop("sheet_row")
    files.write_csv(sheet, path)
    return clean.clean_buildings(files.read_raw_csv(spark, path, sheet.columns))


@register
def keep_first_line(spark, sf_dir):
    return load.keep_first(lines(spark, sf_dir), LINE_KEYS, LINE_ORDER)


@register
def insert_if_absent(spark, sf_dir):
    """New rows for a target that holds the lines of even orders."""
    batch = lines(spark, sf_dir)
    target = load.keep_first(batch.where(F.col("l_orderkey") % 2 == 0), LINE_KEYS, LINE_ORDER)
    return load.insert_if_absent(batch, target, LINE_KEYS, LINE_ORDER)


@register
def insert_with_missing_keys(spark, sf_dir):
    """Rows with a missing key never conflict and are all inserted."""
    batch = lines(spark, sf_dir).withColumn(
        "l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_linenumber"))
    )
    target = batch.where(F.col("l_orderkey") % 2 == 0)
    return load.insert_if_absent(batch, target, LINE_KEYS, LINE_ORDER)


@register
def load_twice(spark, sf_dir):
    """Row counts and ids after loading half of the buildings, then everything twice."""
    buildings, energy = tables(spark, sf_dir)
    folder = fresh_path(spark, "load")
    half = F.col(S.KEY).cast("bigint") % 2 == 0
    order = ["city"], [S.TARGET]
    load.load_tables(spark, folder, buildings.where(half), energy.where(half), *order)
    for _ in range(2):
        b, e = load.load_tables(spark, folder, buildings, energy, *order)
    counts = e.groupBy(S.YEAR).agg(
        F.count("*").alias("n_energy"),
        F.sum(S.SCORE).alias("sum_score"),
        F.count_distinct("performance_id").alias("n_ids"),
    )
    largest = e.agg(F.max("performance_id")).scalar()
    return counts.withColumns({"n_buildings": b.agg(F.count("*")).scalar(), "largest_id": largest})


@register
def dense_ids(spark, sf_dir):
    energy = views.energy(spark, sf_dir).select(S.KEY, S.YEAR)
    return load.with_dense_id(energy, "performance_id", [S.KEY, S.YEAR])


@register
def running_ids(spark, sf_dir):
    numbered = load.with_running_id(views.energy(spark, sf_dir).select(S.KEY), "performance_id")
    return numbered.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("performance_id").alias("n_ids"),
        (F.min("performance_id") >= 1).alias("positive"),
    )


# Cleaning


@register
def clean_buildings(spark, sf_dir):
    return clean.clean_buildings(views.raw(spark, sf_dir))


@register
def clean_energy(spark, sf_dir):
    return clean.clean_energy(views.raw(spark, sf_dir), year=2024)


@register
def clean_scores_lenient(spark, sf_dir):
    cleaned = clean.clean_energy(views.raw(spark, sf_dir, bad_scores=True), strict=False)
    return cleaned.select(S.KEY, S.SCORE)


@register
def rejected_scores(spark, sf_dir):
    return clean.rejected_scores(views.raw(spark, sf_dir, bad_scores=True))


@register
def duplicate_rows(spark, sf_dir):
    """Complete rows, some of them twice; a column with NULLs among them."""
    rows = lines(spark, sf_dir)
    gapped = rows.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")))
    return clean.duplicate_rows(gapped.unionByName(rows.where(F.col("l_partkey") % 5 == 0)))


@register
def length_violations(spark, sf_dir):
    return clean.length_violations(views.buildings(spark, sf_dir), TIGHT_LIMITS)


@register
def nan_to_null(spark, sf_dir):
    """NaN in another year of each measure."""
    measures = [name for name, kind in views.energy(spark, sf_dir).dtypes if kind == "double"]
    odd = {
        name: F.when(F.col(S.YEAR) == 1995 + k % 7, F.lit(float("nan"))).otherwise(F.col(name))
        for k, name in enumerate(measures)
    }
    return clean.null_out_nan(views.energy(spark, sf_dir).withColumns(odd))


# Quality rules


@register
def quality_report(spark, sf_dir):
    return quality.quality_report(*tables(spark, sf_dir))


@register
def quality_report_broken(spark, sf_dir):
    return quality.quality_report(
        views.buildings(spark, sf_dir), views.broken_energy(spark, sf_dir), (1996, 2000)
    )


@register
def quality_report_missing_columns(spark, sf_dir):
    """Two columns of one table and one of the other are absent."""
    buildings, energy = tables(spark, sf_dir)
    return quality.quality_report(
        buildings.drop("city", "postal_code"), energy.drop("gas_intensity_gj_m2")
    )


@register
def orphan_rows(spark, sf_dir):
    return quality.orphan_summary(
        views.broken_energy(spark, sf_dir), views.buildings(spark, sf_dir), S.KEY
    )


@register
def repeated_line_keys(spark, sf_dir):
    return quality.extra_rows_per_key(lines(spark, sf_dir), LINE_KEYS)


@register
def one_row_per_building(spark, sf_dir):
    return quality.key_summary(model_frame(spark, sf_dir), S.KEY)


# Modeling dataset


@register
def model_dataset(spark, sf_dir):
    return model_frame(spark, sf_dir)


@register
def latest_year_rows(spark, sf_dir):
    return dataset.latest_version(views.broken_energy(spark, sf_dir), S.KEY, S.YEAR)


@register
def dropped_rows(spark, sf_dir):
    return features.dropped_rows(model_frame(spark, sf_dir))


# Profile


@register
def shape_and_types(spark, sf_dir):
    return profile.shape_and_types(model_frame(spark, sf_dir))


@register
def missing_summary(spark, sf_dir):
    return profile.missing_values(model_frame(spark, sf_dir))


@register
def missing_target(spark, sf_dir):
    return profile.missing_in(model_frame(spark, sf_dir), S.TARGET)


@register
def describe_target(spark, sf_dir):
    return rounded(profile.describe(model_columns(spark, sf_dir, S.TARGET), S.TARGET))


@register
def describe_large_target(spark, sf_dir):
    frame = materialize(views.energy(spark, sf_dir).select(S.TARGET), "target")
    return rounded(profile.describe(frame, S.TARGET, max_rows=SPLIT_ROWS))


@register
def price_quantiles_by_flag(spark, sf_dir):
    rows = views.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    return rounded(exact_quantiles(rows, "l_extendedprice", wanted, ["l_returnflag"]))


@register
def price_quantiles_by_large_flag(spark, sf_dir):
    rows = views.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    return rounded(
        exact_quantiles(rows, "l_extendedprice", wanted, ["l_returnflag"], max_rows=SPLIT_ROWS)
    )


def odd_prices(spark, sf_dir):
    """Prices with infinities and NaN among them."""
    order = F.col("l_orderkey")
    odd = (
        F.when(order % 17 == 0, F.lit(float("inf")))
        .when(order % 19 == 0, F.lit(float("-inf")))
        .when(order % 23 == 0, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
    )
    return views.table(spark, sf_dir, "lineitem").select("l_returnflag", odd.alias("x"))


def odd_quantiles(spark, sf_dir, **settings):
    wanted = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "highest": 1.0}
    found = exact_quantiles(odd_prices(spark, sf_dir), "x", wanted, ["l_returnflag"], **settings)
    return rounded(
        found.select(
            "l_returnflag",
            "n",
            "q1",
            "median",
            (F.col("lowest") == float("-inf")).alias("lowest_is_infinite"),
            F.isnan("highest").alias("highest_is_nan"),
        )
    )


@register
def quantiles_with_infinities(spark, sf_dir):
    return odd_quantiles(spark, sf_dir)


@register
def quantiles_with_infinities_large(spark, sf_dir):
    return odd_quantiles(spark, sf_dir, max_rows=SPLIT_ROWS)


@register
def type_counts(spark, sf_dir):
    return ranking.category_counts(model_frame(spark, sf_dir), "largest_property_type")


@register
def year_counts(spark, sf_dir):
    return ranking.value_counts(model_frame(spark, sf_dir), S.YEAR)


@register
def top_types(spark, sf_dir):
    return ranking.top_categories(model_frame(spark, sf_dir), "self_property_type", 3)


@register
def string_profile(spark, sf_dir):
    return profile.text_profile(views.raw(spark, sf_dir), S.RAW_PROFILE_COLUMNS, "sheet_row")


@register
def property_match_rates(spark, sf_dir):
    return rounded(profile.match_rates(model_frame(spark, sf_dir), S.PROPERTY_TYPES))


@register
def iqr_summary(spark, sf_dir):
    return rounded(profile.outlier_summary(model_columns(spark, sf_dir, S.TARGET), S.TARGET))


@register
def iqr_outliers(spark, sf_dir):
    columns = [S.KEY, "primary_property_type"]
    return profile.outliers(model_columns(spark, sf_dir, *columns, S.TARGET), S.TARGET, columns)


@register
def largest_outliers(spark, sf_dir):
    columns = [S.KEY, "primary_property_type"]
    return profile.largest_outliers(model_columns(spark, sf_dir, *columns, S.TARGET), S.TARGET, columns)


@register
def hist_equal_width(spark, sf_dir):
    return rounded(distribution.equal_width_histogram(model_columns(spark, sf_dir, S.TARGET), S.TARGET))


@register
def hist_log(spark, sf_dir):
    return rounded(distribution.log_histogram(model_columns(spark, sf_dir, S.TARGET), S.TARGET))


@register
def box_stats_by_type(spark, sf_dir):
    frame = model_columns(spark, sf_dir, "primary_property_type", S.TARGET)
    return rounded(
        distribution.box_stats(frame, "primary_property_type", S.TARGET, 8, positive_only=True)
    )


@register
def box_stats_by_city(spark, sf_dir):
    frame = model_columns(spark, sf_dir, "city", S.TARGET)
    return rounded(distribution.box_stats(frame, "city", S.TARGET, 10))


@register
def box_stats_by_large_type(spark, sf_dir):
    buildings, energy = tables(spark, sf_dir)
    joined = analysis.join_buildings(buildings, energy, ["primary_property_type"])
    frame = materialize(joined.select("primary_property_type", S.TARGET), "typed")
    return rounded(
        distribution.box_stats(frame, "primary_property_type", S.TARGET, 3, max_rows=SPLIT_ROWS)
    )


@register
def box_fliers_by_type(spark, sf_dir):
    frame = model_columns(spark, sf_dir, S.KEY, "primary_property_type", S.TARGET)
    return distribution.box_fliers(
        frame, "primary_property_type", S.TARGET, 8, S.KEY, positive_only=True
    )


@register
def target_correlations(spark, sf_dir):
    return rounded(
        profile.target_correlations(model_frame(spark, sf_dir), S.TARGET, [S.KEY, S.YEAR])
    )


@register
def correlation_pairs(spark, sf_dir):
    return rounded(profile.correlation_pairs(model_frame(spark, sf_dir), [S.KEY, S.YEAR]))


@register
def leakage_watchlist(spark, sf_dir):
    return rounded(
        profile.watchlist_correlations(model_frame(spark, sf_dir), S.TARGET, S.WATCHLIST)
    )


# Features and split


@register
def engineered_features(spark, sf_dir):
    return features.engineer_features(model_frame(spark, sf_dir)).select(
        S.KEY, *features.ENGINEERED
    )


@register
def feature_summary(spark, sf_dir):
    engineered = features.engineer_features(features.drop_missing_target(model_frame(spark, sf_dir)))
    return rounded(features.feature_summary(engineered))


@register
def feature_set_v1(spark, sf_dir):
    return features.select_features(prepared(spark, sf_dir), "v1", keep=[S.KEY])


@register
def feature_set_v2(spark, sf_dir):
    return features.select_features(prepared(spark, sf_dir), "v2", keep=[S.KEY])


@register
def hash_split(spark, sf_dir):
    return prepared(spark, sf_dir).select(S.KEY, "is_test")


@register
def exact_split(spark, sf_dir):
    frame = features.drop_missing_target(model_frame(spark, sf_dir)).select(S.KEY)
    return features.exact_split(materialize(frame, "keys"), S.KEY)


@register
def exact_split_large(spark, sf_dir):
    frame = views.table(spark, sf_dir, "orders").select(F.col("o_orderkey"))
    return features.exact_split(frame, "o_orderkey", max_rows=SPLIT_ROWS)


@register
def exact_split_missing_key(spark, sf_dir):
    """One row has no key; it falls on a side like any other."""
    key = F.when(F.col("o_orderkey") != 7, F.col("o_orderkey")).alias("o_orderkey")
    return features.exact_split(views.table(spark, sf_dir, "orders").select(key), "o_orderkey")


@register
def label_check(spark, sf_dir):
    return features.label_check(prepared(spark, sf_dir))


@register
def onehot_features(spark, sf_dir):
    """Per test row: the width of its vector and how many of its categories are known."""
    frame = materialize(prepared(spark, sf_dir), "prepared")
    train, test = frame.where(~F.col("is_test")), frame.where(F.col("is_test"))
    encoder = features.build_encoder(features.CATEGORICAL).fit(train)
    entries = vector_to_array("features")
    return encoder.transform(test).select(
        S.KEY,
        F.size(entries).cast("bigint").alias("width"),
        F.aggregate(entries, F.lit(0.0), lambda a, b: a + b).cast("bigint").alias("n_known"),
    )


# A join on a key that a third of the rows share


@register
def frequent_key_join(spark, sf_dir):
    """Order lines and their suppliers, where the lines of every third order have one supplier."""
    supplier = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey")).cast("bigint")
    rows = views.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, supplier.alias("key"))
    parents = views.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("key"), "s_name")
    return join_frequent(rows, parents, ["key"], frequent=1000)


# Quoted texts with line breaks


@register
def csv_line_breaks(spark, sf_dir):
    """Texts with line breaks, quotes and commas, through CSV files that many tasks read."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    path = fresh_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


# Experiments


@register
def median_baseline_metrics(spark, sf_dir):
    frame = materialize(prepared(spark, sf_dir).select(S.TARGET, "is_test"), "prepared")
    return rounded(experiments.scores(experiments.median_predictions(frame)))


@register
def largest_errors_baseline(spark, sf_dir):
    frame = prepared(spark, sf_dir).select(*experiments.CONTEXT, S.TARGET, "is_test")
    frame = materialize(frame, "prepared")
    return rounded(experiments.largest_errors(experiments.median_predictions(frame)))


FOREST = experiments.Forest()
_GRIDS: dict[tuple[str, str], DataFrame] = {}


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the whole grid, written once per session: five queries report on them."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _GRIDS:
        _GRIDS[at] = materialize(experiments.run_grid(prepared(spark, sf_dir), FOREST), "grid")
    return _GRIDS[at]


@register
def experiment_grid(spark, sf_dir):
    return experiments.results_table(grid(spark, sf_dir), FOREST)


@register
def best_by_metric(spark, sf_dir):
    return experiments.best_by_metric(experiments.results_table(grid(spark, sf_dir)))


@register
def feature_set_comparison(spark, sf_dir):
    return experiments.compare_feature_sets(experiments.results_table(grid(spark, sf_dir)))


@register
def baseline_consistency(spark, sf_dir):
    return rounded(experiments.baseline_consistency(experiments.results_table(grid(spark, sf_dir))))


@register
def forest_training_means(spark, sf_dir):
    """One tree over all training rows, grown to its end, gives each row the mean of the rows with its features."""
    chosen = features.FEATURE_SETS["v2"]
    train = materialize(prepared(spark, sf_dir).where(~F.col("is_test")).select(S.KEY, S.TARGET, *chosen["categorical"], *chosen["numeric"]), "train")
    tree = forests.fit(train, S.KEY, S.TARGET, chosen["categorical"], chosen["numeric"], trees=1, bagged=False)
    return rounded(forests.with_predictions(tree, train, "predicted").select(S.KEY, "predicted"))


@register
def least_squares_metrics(spark, sf_dir):
    """Scores of least squares on one category, and on one number."""
    frame = materialize(prepared(spark, sf_dir).select("primary_property_type", "n_property_types", S.TARGET, "is_test"), "prepared")
    train, test = frame.where(~F.col("is_test")), frame.where("is_test")
    parts = []
    for name, columns in (("category", (["primary_property_type"], [])), ("number", ([], ["n_property_types"]))):
        model = leastsquares.fit(train, [F.col(S.TARGET)], *columns)
        found = model.with_predictions(test, ["predicted"]).select(F.lit(name).alias("features"), F.col(S.TARGET).alias("actual"), "predicted")
        parts.append(found)
    return rounded(experiments.scores(parts[0].unionByName(parts[1]), ["features"]))


# The reports over predictions that SQL makes, the same in both engines.


def stated_predictions(spark, sf_dir):
    return materialize(views.predictions(spark, sf_dir), "predictions")


@register
def report_scores(spark, sf_dir):
    return rounded(experiments.results_table(stated_predictions(spark, sf_dir)))


@register
def report_best(spark, sf_dir):
    return rounded(experiments.best_by_metric(experiments.results_table(stated_predictions(spark, sf_dir))))


@register
def report_comparison(spark, sf_dir):
    table = experiments.results_table(stated_predictions(spark, sf_dir))
    return rounded(experiments.compare_feature_sets(table))


@register
def report_largest_errors(spark, sf_dir):
    predictions = stated_predictions(spark, sf_dir)
    return rounded(experiments.errors_of_best(predictions, experiments.results_table(predictions)))


@register
def largest_errors_best(spark, sf_dir):
    predictions = grid(spark, sf_dir)
    return experiments.errors_of_best(predictions, experiments.results_table(predictions))
