import pytest
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.operators import features as FE
from tests.conftest import pairs


@pytest.fixture(scope="module")
def sample(spark):
    rows = [
        ("1", "Toronto", "M5V", "Office", "Office", None, 1.0),
        ("2", "Toronto", "M5V", "Office", "Office,Parking", "LEED", 2.0),
        ("3", "Ottawa", "K1A", "Retail", "Retail,Data Center", None, None),
        ("4", "Ottawa", "K1A", "Retail", "Retail", None, 4.0),
    ]
    return spark.createDataFrame(
        [(k, c, p, t, t, t, a, cert, y) for k, c, p, t, a, cert, y in rows],
        "ewrb_id string, city string, postal_code string, primary_property_type string, "
        "self_property_type string, largest_property_type string, all_property_types string, "
        "third_party_certification string, site_eui_gj_m2 double",
    )


def test_target_is_dropped_never_filled(sample):
    assert pairs(FE.drop_missing_target(sample).select("ewrb_id")) == [("1",), ("2",), ("4",)]
    assert tuple(FE.dropped_rows(sample).first()) == (4, 3, 1)


def test_engineered_values(sample):
    got = FE.engineer_features(sample).select("ewrb_id", *FE.ENGINEERED)
    assert pairs(got) == [("1", 1, 0, 0), ("2", 2, 1, 0), ("3", 2, 0, 1), ("4", 1, 0, 0)]
    assert tuple(FE.feature_summary(FE.engineer_features(sample)).first()) == (1, 2, 1.5, 3, 1, 3, 1)


def test_feature_sets(sample):
    engineered = FE.engineer_features(sample)
    v1 = FE.select_features(engineered, "v1")
    assert v1.columns == [*FE.CATEGORICAL, S.TARGET]
    assert FE.select_features(engineered, "v2").columns == [*FE.CATEGORICAL, *FE.ENGINEERED, S.TARGET]
    with pytest.raises(ValueError, match="unknown feature set"):
        FE.select_features(engineered, "v99")
    with pytest.raises(ValueError, match="not found"):
        FE.select_features(sample, "v2")


def test_split_does_not_depend_on_row_order(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("ewrb_id"))
    one = FE.hash_split(df, "ewrb_id")
    other = FE.hash_split(df.orderBy(F.desc("ewrb_id")).repartition(13), "ewrb_id")
    assert pairs(one) == pairs(other)
    assert 340 < one.where("is_test").count() < 460
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()


def test_label_check(sample):
    split = FE.hash_split(sample, "ewrb_id")
    got = FE.label_check(split).agg(F.sum("n_rows"), F.sum("missing_labels")).first()
    assert tuple(got) == (4, 1)


def test_encoder_stages_and_unseen_categories(spark):
    train = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "c string, n int")
    test = spark.createDataFrame([("a", 7), ("zz", 8), (None, 9)], "c string, n int")
    stages = FE.build_encoder(["c"], ["n"]).getStages()
    assert [type(s) for s in stages[1:]] == [StringIndexer, OneHotEncoder, VectorAssembler]
    assert stages[-1].getInputCols() == ["c_vector", "n"]
    assert FE.build_encoder(["c"]).getStages()[-1].getInputCols() == ["c_vector"]
    model = FE.build_encoder(["c"], ["n"]).fit(train)
    got = {r["n"]: list(r["features"]) for r in model.transform(test).collect()}
    assert got[8] == [0.0, 0.0, 0.0, 8.0]
    assert sum(got[7][:3]) == 1.0 and sum(got[9][:3]) == 1.0 and got[7][:3] != got[9][:3]


def test_split_shares_at_both_ends_and_missing_keys(spark):
    df = spark.range(500).select(F.when(F.col("id") != 3, F.col("id").cast("string")).alias("k"))
    for share, n in ((0.0, 0), (1.0, 500)):
        assert FE.hash_split(df, "k", share).where("is_test").count() == n
        assert FE.exact_split(df, "k", share).where("is_test").count() == n
    assert FE.hash_split(df, "k").where("is_test is null").count() == 0
    for max_rows in (5, 1000):
        split = FE.exact_split(df, "k", max_rows=max_rows)
        assert split.where("is_test").count() == 100 and split.where("is_test is null").count() == 0
