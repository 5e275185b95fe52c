import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions import scalar as X
from meterlark.operators import clean


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_missing_text_is_matched_exactly(spark):
    df = texts(spark, "Not Available", "not available", "Not Available ", None)
    assert one(df, X.blank_to_null(F.col("t"), "Not Available")) == [
        None,
        "not available",
        "Not Available ",
        None,
    ]


def test_lenient_numbers_never_fail(spark):
    df = texts(spark, "1.5", " 2.5e1 ", "-.5", "3.", "1.5d", "1_0", "inf", "NaN", "1e999", "", "abc", None)
    expected = [1.5, 25.0, -0.5, 3.0] + [None] * 8
    assert one(df, clean.clean_measure(F.col("t"))) == expected


def test_scores_accept_whole_numbers_only(spark):
    df = texts(spark, "75", "75.0", "Not Available", None)
    assert one(df, clean.clean_score(F.col("t"))) == [75, 75, None, None]
    for bad in ("75.5", "abc", "", "3000000000"):
        with pytest.raises(PySparkException, match="not an integer"):
            texts(spark, bad).select(clean.clean_score(F.col("t"))).collect()
        assert one(texts(spark, bad), clean.clean_score(F.col("t"), strict=False)) == [None]


def test_key_loses_only_the_replacement_character(spark):
    df = texts(spark, "12�", " 7 ", "a�b�", None)
    assert one(df, clean.clean_key(F.col("t"))) == ["12", " 7 ", "ab", None]


def raw_row(**changes):
    row = dict.fromkeys([*S.BUILDING_COLUMNS, *S.MEASURE_COLUMNS, S.RAW_SCORE], "Not Available")
    return {**row, **changes}


def test_only_the_certification_column_drops_the_missing_text(spark):
    raw = spark.createDataFrame([raw_row(EWRB_ID="1�")], S.raw_sheet())
    cleaned = clean.clean_buildings(raw)
    assert cleaned.columns == S.BUILDINGS.names
    row = cleaned.first()
    assert row["ewrb_id"] == "1"
    assert row["city"] == "Not Available"
    assert row["third_party_certification"] is None


def test_energy_has_the_year_in_second_place(spark):
    raw = spark.createDataFrame(
        [raw_row(EWRB_ID="1", Site_EUI1="0.7", Ener_Star_Score="80")], S.raw_sheet()
    )
    cleaned = clean.clean_energy(raw, year=2023)
    assert [(f.name, f.dataType) for f in cleaned.schema] == [(f.name, f.dataType) for f in S.ENERGY]
    row = cleaned.first()
    assert (row["reporting_year"], row["site_eui_gj_m2"], row["energy_star_score"]) == (2023, 0.7, 80)
    assert row["gas_intensity_gj_m2"] is None


def test_duplicate_rows_counts_repeats(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, 2), (1, 2)], "a int, b int")
    assert clean.duplicate_rows(df).first()[0] == 3
    assert clean.duplicate_rows(df.limit(0)).first()[0] == 0


def test_length_limits(spark):
    df = spark.createDataFrame([("12345678901", "x"), ("1", None)], "ewrb_id string, city string")
    counted = {r["column_name"]: r["violations"] for r in clean.length_violations(df).collect()}
    assert counted == {"ewrb_id": 1, "city": 0}
    with pytest.raises(PySparkException, match="longer than 10"):
        clean.enforce_lengths(df).collect()


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int")
    assert [tuple(r) for r in clean.null_out_nan(df).collect()] == [(None, 1), (2.0, 2)]


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.675,), (1e25,), (None,)], "x double")
    assert one(df, X.round_half_away(F.col("x"), 2)) == [1.01, 2.5, -2.68, 1e25, None]
    near = df.sparkSession.createDataFrame([(0.00499999999999,), (0.005,)], "x double")
    assert one(near, X.round_half_away(F.col("x"), 2)) == [0.0, 0.01]
    halves = spark.createDataFrame([(0.25,), (0.35,)], "x double")
    assert one(halves, X.round_half_even(F.col("x"), 1)) == [0.2, 0.4]


def test_list_and_flag_functions(spark):
    df = texts(spark, None, "", "a", "a,b,", "Retail,DATA center")
    assert one(df, X.list_length(F.col("t"))) == [1, 1, 1, 3, 2]
    assert one(df, X.contains_ignoring_case(F.col("t"), "Data Center")) == [0, 0, 0, 0, 1]
    assert one(df, X.present_flag(F.col("t"))) == [0, 1, 1, 1, 1]
