import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from meterlark import schemas as S
from meterlark.plans import analysis
from verification import compare, oracle, registry

# Fitting a whole grid takes long; tests/test_experiments.py covers it on a small frame.
GRID = {"experiment_grid", "best_by_metric", "feature_set_comparison", "baseline_consistency", "largest_errors_best"}
NAMES = [name for name in registry.QUERIES if name not in GRID]
UNWANTED = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    result = registry.QUERIES[name](spark, sf_dir)
    assert compare.difference(result, connection, oracle.statements()[name]) == ""
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


def test_every_statement_belongs_to_a_query():
    assert set(oracle.statements()) <= set(entry_point.queries())
    assert set(registry.QUERIES) - set(oracle.statements()) == GRID - {"baseline_consistency"}


def test_entry(spark, sf_dir):
    frame = entry_point.entry(spark)
    assert "is_test" in frame.columns and frame.count() > 0


def plan_of(spark, sf_dir, name):
    return registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_top_k_does_not_sort_all_rows(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "q02_top_ghg_buildings")
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "q04_buildings_by_type")
    assert "c_acctbal" not in plan and "n_name" not in plan.split("ReadSchema")[1]


def test_overall_mean_is_a_subquery(spark, sf_dir):
    assert "Subquery" in plan_of(spark, sf_dir, "q09_cities_above_mean")


def test_a_frequent_key_is_split_in_the_join(spark):
    """A third of the measures belong to one building; adaptive execution splits that key."""
    energy = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 5000 + 2).cast("string")).alias(S.KEY),
        (F.col("id") % 100).cast("int").alias(S.SCORE),
        F.lit(2024).alias(S.YEAR),
    ).repartition(8)
    buildings = spark.range(1, 5003).select(
        F.col("id").cast("string").alias(S.KEY), F.lit("Office").alias("primary_property_type")
    )
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        tiers = analysis.efficiency_tiers(buildings, energy)
        n_rows = len(tiers.collect())
        plan = tiers._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert n_rows == 60_000
    assert "skew=true" in plan
