import pytest
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.operators import quality
from meterlark.plans import analysis, dataset
from tests.conftest import pairs


def energy_row(key, year, score=None, **measures):
    return {S.KEY: key, S.YEAR: year, S.SCORE: score, **{m: measures.get(m) for m in S.MEASURES}}


@pytest.fixture(scope="module")
def buildings(spark):
    rows = [
        ("1", "Toronto", "Office"),
        ("2", "Toronto", "Office"),
        ("3", "Ottawa", "Retail"),
        ("4", "Ottawa", None),
        ("5", "Sudbury", "School"),
    ]
    return spark.createDataFrame(
        [(k, c, "M5V", t, t, t, t, None) for k, c, t in rows],
        ", ".join(f"{name} string" for name in S.BUILDINGS.names),
    )


@pytest.fixture(scope="module")
def energy(spark):
    eui, ghg, wn = S.TARGET, analysis.GHG, analysis.NORMALIZED
    return spark.createDataFrame(
        [
            energy_row("1", 2023, 90, **{eui: 1.0, ghg: 10.0, wn: 1.5}),
            energy_row("1", 2024, 74, **{eui: 2.0, ghg: 30.0, analysis.GAS: 1.0, analysis.WATER: 2.0}),
            energy_row("2", 2024, 50, **{eui: 2.0, ghg: None, wn: 0.5, analysis.GAS: 1.0}),
            energy_row("3", 2024, 49, **{eui: 5.005, ghg: 100.0, wn: 5.0}),
            energy_row("4", 2024, 75, **{eui: 0.0, ghg: 1.0, analysis.WATER: 7.0}),
            energy_row("5", 2024, None, **{eui: None, ghg: 40.0}),
            energy_row("99", 2024, 100, **{eui: 9.0, ghg: 500.0}),
            energy_row(None, 2024, 100, **{eui: 9.0, ghg: 400.0}),
        ],
        S.ENERGY,
    )


def test_mean_by_type_counts_rows_without_a_measure_and_lists_null_first(buildings, energy):
    got = [tuple(r) for r in analysis.mean_eui_by_type(buildings, energy).collect()]
    assert got == [("School", None, 1), ("Retail", 5.01, 1), ("Office", 1.67, 3), (None, 0.0, 1)]


def test_top_ghg_both_null_orders(buildings, energy):
    first = [r["ewrb_id"] for r in analysis.top_ghg_buildings(buildings, energy, 2).collect()]
    last = [r["ewrb_id"] for r in analysis.top_ghg_buildings(buildings, energy, 2, "last").collect()]
    assert (first, last) == (["2", "3"], ["3", "5"])


def test_water_types_and_scores(buildings, energy):
    assert [tuple(r) for r in analysis.mean_water_by_city(buildings, energy).collect()] == [
        ("Sudbury", None),
        ("Ottawa", 7.0),
        ("Toronto", 2.0),
    ]
    assert [tuple(r) for r in analysis.buildings_by_type(buildings).collect()] == [
        ("Office", 2),
        ("Retail", 1),
        ("School", 1),
        (None, 1),
    ]
    assert [tuple(r) for r in analysis.mean_score_by_type(buildings, energy).collect()] == [
        (None, 75.0, 1),
        ("Office", 71.3, 3),
        ("Retail", 49.0, 1),
    ]


def test_weather_gap_and_missing_readings(buildings, energy):
    gaps = analysis.weather_gap(buildings, energy).select("ewrb_id", "diff").collect()
    assert [tuple(r) for r in gaps] == [("2", 1.5), ("3", 0.0), ("1", -0.5)]
    missing = analysis.missing_readings(buildings, energy).select("ewrb_id", "reporting_year")
    assert pairs(missing) == [("1", 2023), ("2", 2024), ("3", 2024), ("4", 2024), ("5", 2024)]


def test_tiers_sort_unscored_last(buildings, energy):
    got = analysis.efficiency_tiers(buildings, energy).select(S.SCORE, "efficiency_tier").collect()
    assert [tuple(r) for r in got] == [
        (90, "High Performer"),
        (75, "High Performer"),
        (74, "Average"),
        (50, "Average"),
        (49, "Low Performer"),
        (None, "Unscored"),
    ]


def test_overall_mean_includes_rows_without_a_building(buildings, energy):
    # Overall mean is 154.4; over joined rows alone it would be 36.2 and keep two cities.
    assert analysis.cities_above_mean(buildings, energy).count() == 0
    joined_only = energy.join(buildings.select(S.KEY), S.KEY, "left_semi")
    got = [tuple(r) for r in analysis.cities_above_mean(buildings, joined_only).collect()]
    assert got == [("Ottawa", 50.5), ("Sudbury", 40.0)]


@pytest.mark.parametrize("max_rows", [1, 1000])
def test_rank_in_type(buildings, energy, max_rows):
    got = analysis.rank_in_type(buildings, energy, max_rows)
    assert [(r["primary_property_type"], r["ewrb_id"], r["eui_rank_in_type"]) for r in got.collect()] == [
        ("Office", "1", 1),
        ("Office", "2", 1),
        ("Office", "1", 3),
        ("Retail", "3", 1),
        (None, "4", 1),
    ]


def test_modeling_dataset_has_the_latest_year_per_building(buildings, energy):
    got = dataset.modeling_dataset(buildings, energy)
    assert len(got.columns) == 19
    assert pairs(got.select(S.KEY, S.YEAR)) == [(k, 2024) for k in "12345"]


def test_latest_version_equals_the_rank_form_and_keeps_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 3, "k"), ("c", 1, "c")],
        "k string, v int, t string",
    )
    assert pairs(dataset.latest_version(df, "k", "v").select("t")) == [("c",), ("y",), ("z",)]


def test_one_hot_building_gives_the_same_means(spark, buildings):
    rows = [energy_row("1", 2000 + i, None, **{S.TARGET: float(i)}) for i in range(60)]
    rows += [energy_row("3", 2024, None, **{S.TARGET: 1.0})]
    got = analysis.mean_eui_by_type(buildings, spark.createDataFrame(rows, S.ENERGY).repartition(8))
    assert pairs(got) == [("Office", 29.5, 60), ("Retail", 1.0, 1)]


def test_quality_rules_count_seeded_violations(spark, buildings, energy):
    broken = energy.unionByName(
        spark.createDataFrame(
            [
                energy_row("1", 2024, **{S.TARGET: -1.0}),
                energy_row("2", 1999),
                energy_row("2", 2101),
                energy_row("3", None),
                energy_row("3", None),
            ],
            S.ENERGY,
        )
    )
    twice = buildings.unionByName(buildings.where("ewrb_id = '1'"))
    report = {(r["table_name"], r["rule"]): r["violations"] for r in quality.quality_report(twice, broken).collect()}
    assert report == {
        ("buildings", "expected_columns"): 0,
        ("buildings", "key_present"): 0,
        ("buildings", "unique_key"): 1,
        ("energy_performance", "expected_columns"): 0,
        ("energy_performance", "target_not_negative"): 1,
        ("energy_performance", "year_in_range"): 2,
        ("energy_performance", "unique_key_and_year"): 1,
        ("energy_performance", "building_exists"): 1,
        ("energy_performance", "key_present"): 1,
    }


def test_quality_rules_report_absent_columns(buildings, energy):
    report = quality.quality_report(buildings.drop("city"), energy.drop(S.TARGET))
    failed = {(r["table_name"], r["rule"]) for r in report.where("not passed").collect()}
    assert ("buildings", "expected_columns") in failed
    assert ("energy_performance", "expected_columns") in failed


def test_key_and_orphan_summaries(buildings, energy):
    assert tuple(quality.key_summary(energy, S.KEY).first()) == (8, 6, False)
    assert tuple(quality.key_summary(buildings, S.KEY).first()) == (5, 5, True)
    assert tuple(quality.orphan_summary(energy, buildings, S.KEY).first()) == (1, 1)
    assert quality.extra_rows_per_key(energy, [S.KEY]).first()[0] == 1
    assert quality.extra_rows_per_key(energy.where(F.lit(False)), [S.KEY]).first()[0] == 0
