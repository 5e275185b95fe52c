import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.session import fresh_path
from meterlark.sources import files, load
from tests.conftest import pairs

SCHEMA = "k string, y int, seq int, v string"
ROWS = [
    ("a", 1, 2, "late"),
    ("a", 1, 1, "early"),
    ("a", 2, 3, "other year"),
    ("b", None, 4, "no year"),
    ("b", None, 5, "no year again"),
    (None, 1, 6, "no key"),
]


def test_first_row_per_key_wins_and_missing_keys_stay(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = {r["v"] for r in load.keep_first(df, ["k", "y"], ["seq"]).collect()}
    assert kept == {"early", "other year", "no year", "no year again", "no key"}
    again = load.keep_first(df.orderBy(F.desc("seq")).repartition(5), ["k", "y"], ["seq"])
    assert {r["v"] for r in again.collect()} == kept


def test_existing_rows_win(spark):
    batch = spark.createDataFrame(ROWS, SCHEMA)
    target = spark.createDataFrame([("a", 1, 0, "there"), (None, 1, 0, "there")], SCHEMA)
    new = {r["v"] for r in load.insert_if_absent(batch, target, ["k", "y"], ["seq"]).collect()}
    assert new == {"other year", "no year", "no year again", "no key"}


def test_second_insert_adds_nothing(spark):
    batch = spark.createDataFrame([r for r in ROWS if None not in r], SCHEMA)
    target = load.insert_if_absent(batch, None, ["k", "y"], ["seq"])
    assert load.insert_if_absent(batch, target, ["k", "y"], ["seq"]).count() == 0


def test_key_only_frame(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert pairs(load.keep_first(df, ["k"], [])) == [(1,), (2,)]


def test_a_frequent_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    plan = load.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_dense_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    numbered = load.with_dense_id(df, "n", ["k"], start=5)
    assert [tuple(r) for r in numbered.orderBy("k").collect()] == [(k + 5, k) for k in range(1000)]


def test_running_ids_are_unique(spark):
    ids = [r[0] for r in load.with_running_id(spark.range(500).repartition(6), "n", 10).collect()]
    assert len(set(ids)) == 500 and min(ids) >= 10


def building(key, city="Ottawa"):
    return (key, city, "K1A", "Office", "Office", "Office", "Office", None)


def energy(key, year=2024, eui=1.0):
    return (key, year, *[eui] * 9, 70)


def loaded(spark, folder):
    b = files.read_table(spark, f"{folder}/buildings", S.BUILDINGS)
    return {r["ewrb_id"]: r["city"] for r in b.collect()}


def load_all(spark, folder, buildings, energy):
    return load.load_tables(spark, folder, buildings, energy, ["city"], [S.TARGET])


def make(spark, buildings, energies):
    text = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.BUILDINGS)
    return spark.createDataFrame(buildings, text), spark.createDataFrame(energies, S.ENERGY)


def test_load_is_idempotent_and_never_updates(spark):
    folder = fresh_path(spark, "test-load")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    for _ in range(2):
        b, e = load_all(
            spark,
            folder,
            *make(spark, [building("1", "Changed"), building("2")], [energy("1"), energy("2", eui=float("nan"))]),
        )
    assert loaded(spark, folder) == {"1": "Ottawa", "2": "Ottawa"}
    assert pairs(e.select("performance_id", "ewrb_id", "site_eui_gj_m2")) == [(1, "1", 1.0), (2, "2", None)]


def test_a_bad_building_batch_loads_nothing(spark):
    folder = fresh_path(spark, "test-load")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    for bad in (building("12345678901"), building(None)):
        with pytest.raises(PySparkException):
            load_all(spark, folder, *make(spark, [building("2"), bad], [energy("2")]))
    assert loaded(spark, folder) == {"1": "Ottawa"}


def test_the_first_row_by_the_given_order_is_loaded(spark):
    b, e = make(spark, [building("1", "Zed"), building("1", None)], [energy("1", eui=5.0), energy("1", eui=2.0)])
    b = b.withColumn("line", F.when(F.col("city") == "Zed", 1).otherwise(2))
    e = e.withColumn("line", -F.col("site_eui_gj_m2"))
    b, e = load.load_tables(spark, fresh_path(spark, "test-load"), b, e, ["line"], ["line"])
    assert pairs(b.select("city")) == [("Zed",)] and pairs(e.select("site_eui_gj_m2")) == [(5.0,)]


def test_known_keys_are_sought_in_the_years_of_the_batch_only(spark):
    folder = fresh_path(spark, "test-load")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1", 2023), energy("1", 2024)]))
    _, e = load_all(spark, folder, *make(spark, [building("1")], [energy("1", 2024), energy("1", 2025)]))
    assert pairs(e.select("performance_id", "reporting_year")) == [(1, 2023), (2, 2024), (3, 2025)]
    plan = e.where(F.col(S.YEAR).isin([2024, 2025]))._jdf.queryExecution().toString()
    assert "PartitionFilters: [reporting_year" in plan


def test_a_bad_batch_leaves_both_tables_as_they_were(spark):
    folder = fresh_path(spark, "test-load")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    with pytest.raises(ValueError, match="1 energy rows"):
        load_all(spark, folder, *make(spark, [building("2")], [energy("2"), energy("9")]))
    assert set(loaded(spark, folder)) == {"1"}
    e = files.read_table(spark, f"{folder}/energy_performance", S.ENERGY)
    assert pairs(e.select("ewrb_id")) == [("1",)]


def test_csv_round_trip_keeps_commas_quotes_and_null(spark):
    path = fresh_path(spark, "test-csv")
    df = spark.createDataFrame(
        [
            ("a,b", 1.5, 1),
            ('say "x"', None, None),
            (None, 2.0, 3),
            ("two\nlines", 1.0, 4),
            ('"', 1.0, 5),
            ("back\\slash", 1.0, 6),
            (" blanks ", 1.0, 7),
            ("", 1.0, 8),
        ],
        "t string, x double, i int",
    )
    files.write_csv(df, path)
    assert pairs(files.read_csv(spark, path, df.schema)) == pairs(df)


def test_raw_sheet_of_another_program_is_read(spark, tmp_path):
    (tmp_path / "raw.csv").write_text('EWRB_ID,City,Note\n1,"say ""x"", y","two\nlines"\n2,,plain\n')
    got = files.read_raw_csv(spark, str(tmp_path / "raw.csv"), ["EWRB_ID", "City", "Note"])
    assert pairs(got) == [("1", 'say "x", y', "two\nlines"), ("2", None, "plain")]


def test_year_filter_prunes_partitions(spark):
    path = fresh_path(spark, "test-parts")
    df = spark.createDataFrame([energy("1", 2023), energy("1", 2024)], S.ENERGY)
    files.write_table(df, path, partition_by=S.YEAR)
    one = files.read_table(spark, path, S.ENERGY).where(F.col(S.YEAR) == 2024)
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(reporting_year" in one._jdf.queryExecution().toString()
