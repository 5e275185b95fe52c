import pytest
from pyspark.sql import functions as F

from meterlark.functions.joins import join_frequent
from tests.conftest import pairs


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows has key 1, some have no key, and key 2 has two parents, key 900 and above none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 997)
    rows = spark.range(6000).select(key.cast("long").alias("k"), F.col("id").alias("r"))
    parents = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 7).alias("p"))
    extra = spark.createDataFrame([(2, -1), (None, -2)], "k long, p long")
    return rows, parents.unionByName(extra)


@pytest.mark.parametrize(("frequent", "most"), [(10**6, 100), (100, 100), (4, 10**6), (4, 3), (1, 0)])
def test_same_rows_as_a_plain_join(sides, frequent, most):
    rows, parents = sides
    got = join_frequent(rows, parents, ["k"], frequent, most)
    assert got.columns == ["k", "r", "p"]
    assert pairs(got) == pairs(rows.join(parents, "k"))


def test_a_frequent_key_is_spread_without_adaptive_execution(spark, sides):
    rows, parents = sides
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:

        def largest(joined):
            return joined.where("k = 1").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        wide = rows.repartition(8)
        assert largest(wide.join(parents, "k")) >= 2000
        assert largest(join_frequent(wide, parents, ["k"], 100)) < 400
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_empty_sides_and_several_keys(spark, sides):
    rows, parents = sides
    assert join_frequent(rows.limit(0), parents, ["k"], 1).count() == 0
    assert join_frequent(rows, parents.limit(0), ["k"], 1).count() == 0
    rows, parents = rows.withColumn("l", F.col("k") % 2), parents.withColumn("l", F.lit(1).cast("long"))
    assert pairs(join_frequent(rows, parents, ["k", "l"], 5)) == pairs(rows.join(parents, ["k", "l"]))
