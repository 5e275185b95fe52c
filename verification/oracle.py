"""SQL equivalents of the registered queries, written for DuckDB and independent of the library."""

from __future__ import annotations

from verification import views

MEASURES = [
    "electricity_intensity_gj_m2",
    "gas_intensity_gj_m2",
    "water_intensity_m3_m2",
    "indoor_water_intensity_m3_m2",
    "site_eui_gj_m2",
    "weather_normalized_site_eui_gj_m2",
    "source_eui_gj_m2",
    "weather_normalized_source_eui_gj_m2",
    "ghg_intensity_kgco2e_m2",
]
BUILDING_COLUMNS = [
    "ewrb_id",
    "city",
    "postal_code",
    "primary_property_type",
    "self_property_type",
    "largest_property_type",
    "all_property_types",
    "third_party_certification",
]
NUMBERS = [*MEASURES, "energy_star_score"]
MODEL_COLUMNS = [*BUILDING_COLUMNS, "reporting_year", *NUMBERS]
TARGET = "site_eui_gj_m2"

TABLES = f"buildings AS ({views.BUILDINGS}), energy_performance AS ({views.ENERGY})"
MODEL = f"""{TABLES},
model AS (
    SELECT b.*, e.* EXCLUDE (ewrb_id)
    FROM buildings b JOIN energy_performance e ON b.ewrb_id = e.ewrb_id
    JOIN (SELECT ewrb_id, max(reporting_year) AS max_year FROM energy_performance GROUP BY 1) ly
      ON e.ewrb_id = ly.ewrb_id AND e.reporting_year = ly.max_year
)"""
KNOWN = f"{MODEL}, known AS (SELECT * FROM model WHERE {TARGET} IS NOT NULL)"
SPLIT = f"""{KNOWN},
split AS (
    SELECT *, substr(md5(concat('42:', ewrb_id)), 1, 8) < '33333333' AS is_test FROM known
)"""
JOINED = "buildings b JOIN energy_performance e ON b.ewrb_id = e.ewrb_id"


def with_tables(body: str) -> str:
    return f"WITH {TABLES} {body}"


def with_model(body: str) -> str:
    return f"WITH {MODEL} {body}"


def with_known(body: str) -> str:
    return f"WITH {KNOWN} {body}"


def with_split(body: str) -> str:
    return f"WITH {SPLIT} {body}"


def with_raw(body: str, bad_scores: bool = False) -> str:
    return f"WITH raw AS ({views.raw_sheet(bad_scores)}) {body}"


def rounded_number(value: str, digits: int) -> str:
    """A double's 15 significant digits, then ties away from zero."""
    return f"cast(round(cast(printf('%.14e', cast({value} AS double)) AS decimal(38, 18)), {digits}) AS double)"


def rounded_mean(column: str, digits: int) -> str:
    return rounded_number(f"avg({column})", digits)


def lenient(column: str) -> str:
    pattern = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
    return f"CASE WHEN regexp_full_match({column}, '{pattern}') THEN try_cast(trim({column}) AS double) END"


def whole(column: str) -> str:
    number = f"({lenient(column)})"
    return f"CASE WHEN {number} = floor({number}) THEN cast({number} AS int) END"


LINE_COLUMNS = """l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
        l_discount, l_tax, l_returnflag, l_linestatus"""


def first_lines(source: str) -> str:
    return f"""
    SELECT {LINE_COLUMNS}
    FROM {source}
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
                 l_discount, l_tax, l_returnflag, l_linestatus) = 1"""


def rank_query() -> str:
    return with_tables(f"""
    SELECT b.ewrb_id, b.city, b.primary_property_type, e.{TARGET},
           cast(rank() OVER (PARTITION BY b.primary_property_type ORDER BY e.{TARGET} DESC) AS bigint)
               AS eui_rank_in_type
    FROM {JOINED} WHERE e.{TARGET} IS NOT NULL""")


def top_ghg(nulls: str) -> str:
    return with_tables(f"""
    SELECT b.ewrb_id, b.city, b.primary_property_type, e.ghg_intensity_kgco2e_m2
    FROM {JOINED}
    ORDER BY e.ghg_intensity_kgco2e_m2 DESC NULLS {nulls}, b.ewrb_id, e.reporting_year LIMIT 10""")


def describe(source: str, prefix: str) -> str:
    return f"""{prefix}
    SELECT count({TARGET}) AS n, round(avg({TARGET}), 6) AS mean,
           round(stddev_samp({TARGET}), 6) AS std, round(min({TARGET}), 6) AS min,
           round(quantile_cont({TARGET}, 0.25), 6) AS q1,
           round(quantile_cont({TARGET}, 0.5), 6) AS median,
           round(quantile_cont({TARGET}, 0.75), 6) AS q3, round(max({TARGET}), 6) AS max
    FROM {source}"""


PRICE_QUANTILES = """
    SELECT l_returnflag, count(*) AS n,
           round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
           round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
           round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
           round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
    FROM lineitem GROUP BY l_returnflag"""


# NaN sorts last in both engines.
ODD_QUANTILES = """
    WITH v AS (
        SELECT l_returnflag, CASE WHEN l_orderkey % 17 = 0 THEN 'inf'::double
                                  WHEN l_orderkey % 19 = 0 THEN '-inf'::double
                                  WHEN l_orderkey % 23 = 0 THEN 'nan'::double
                                  ELSE l_extendedprice END AS x FROM lineitem),
    placed AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY x) - 1 AS pos,
                      count(*) OVER (PARTITION BY l_returnflag) AS n FROM v)
    SELECT l_returnflag, max(n) AS n,
           round(sum(x * (1 - abs(pos - (n - 1) * 0.25))) FILTER (abs(pos - (n - 1) * 0.25) < 1), 6) AS q1,
           round(sum(x * (1 - abs(pos - (n - 1) * 0.5))) FILTER (abs(pos - (n - 1) * 0.5) < 1), 6) AS median,
           bool_or(pos = 0 AND x = '-inf'::double) AS lowest_is_infinite,
           bool_or(pos = n - 1 AND isnan(x)) AS highest_is_nan
    FROM placed GROUP BY l_returnflag"""


def rule_rows(buildings: str, energy: str, low: int, high: int, absent_b: int = 0, absent_e: int = 0) -> str:
    return f"""
    SELECT *, violations = 0 AS passed FROM (
      SELECT 'expected_columns' AS rule, 'buildings' AS table_name, cast({absent_b} AS bigint) AS violations
        FROM (SELECT count(*) FROM {buildings})
      UNION ALL SELECT 'key_present', 'buildings', count(*) FROM {buildings} WHERE ewrb_id IS NULL
      UNION ALL SELECT 'unique_key', 'buildings', count(ewrb_id) - count(DISTINCT ewrb_id) FROM {buildings}
      UNION ALL SELECT 'expected_columns', 'energy_performance', cast({absent_e} AS bigint)
        FROM (SELECT count(*) FROM {energy})
      UNION ALL SELECT 'target_not_negative', 'energy_performance', count(*) FROM {energy}
        WHERE {TARGET} < 0
      UNION ALL SELECT 'year_in_range', 'energy_performance', count(*) FROM {energy}
        WHERE reporting_year < {low} OR reporting_year > {high}
      UNION ALL SELECT 'unique_key_and_year', 'energy_performance',
          count(*) - count(DISTINCT (ewrb_id, reporting_year)) FROM {energy} WHERE ewrb_id IS NOT NULL
      UNION ALL SELECT 'building_exists', 'energy_performance', count(*) FROM {energy} e
        WHERE ewrb_id IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {buildings} b WHERE b.ewrb_id = e.ewrb_id)
      UNION ALL SELECT 'key_present', 'energy_performance', count(*) FROM {energy} WHERE ewrb_id IS NULL
    )"""


def union_of(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def histogram_query(edges: str, values: str) -> str:
    return with_model(f"""
    , v AS (SELECT {TARGET} AS x FROM model WHERE {values}),
    b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
    bins AS ({edges})
    SELECT cast(bin AS int) AS bin, round(bin_start, 6) AS bin_start, round(bin_end, 6) AS bin_end,
           count(x) AS n
    FROM bins LEFT JOIN v ON x >= bin_start AND (x < bin_end OR (is_last AND x <= bin_end))
    GROUP BY bin, bin_start, bin_end""")


EQUAL_EDGES = """
    SELECT i AS bin, lo + i * ((hi - lo) / 40) AS bin_start,
           CASE WHEN i = 39 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 40) END AS bin_end,
           i = 39 AS is_last
    FROM b, range(40) AS r(i)"""
LOG_EDGES = """
    SELECT i AS bin,
           CASE WHEN i = 0 THEN lo ELSE pow(10, log10(lo) + i * (log10(hi) - log10(lo)) / 39) END
               AS bin_start,
           CASE WHEN i = 38 THEN hi
                ELSE pow(10, log10(lo) + (i + 1) * (log10(hi) - log10(lo)) / 39) END AS bin_end,
           i = 38 AS is_last
    FROM b, range(39) AS r(i)"""


def box_parts(category: str, top_n: int, condition: str, source: str) -> str:
    return f"""
    top AS (SELECT {category}, count(*) AS n_in_category FROM {source}
            WHERE {category} IS NOT NULL GROUP BY 1
            ORDER BY 2 DESC, 1 LIMIT {top_n}),
    picked AS (SELECT m.* FROM {source} m JOIN top USING ({category}) WHERE {condition}),
    q AS (SELECT {category}, count(*) AS n, quantile_cont({TARGET}, 0.25) AS q1,
                 quantile_cont({TARGET}, 0.5) AS median, quantile_cont({TARGET}, 0.75) AS q3
          FROM picked GROUP BY 1)"""


def box_query(category: str, top_n: int, condition: str, prefix: str, source: str) -> str:
    return f"""{prefix}, {box_parts(category, top_n, condition, source)}
    SELECT {category}, any_value(n_in_category) AS n_in_category, any_value(n) AS n,
           round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median,
           round(any_value(q3), 6) AS q3,
           round(least(any_value(q1), min({TARGET}) FILTER (
               {TARGET} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 6) AS whisker_low,
           round(greatest(any_value(q3), max({TARGET}) FILTER (
               {TARGET} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))), 6) AS whisker_high,
           count(*) FILTER ({TARGET} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
               AS n_fliers
    FROM picked JOIN q USING ({category}) JOIN top USING ({category})
    GROUP BY {category}"""


FENCES = f"""
    f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM (SELECT quantile_cont({TARGET}, 0.25) AS q1, quantile_cont({TARGET}, 0.75) AS q3
                FROM model)),
    outside AS (SELECT ewrb_id, primary_property_type, {TARGET} FROM model, f
                WHERE {TARGET} < lo OR {TARGET} > hi)"""


def correlations(columns: list[str]) -> str:
    return union_of(
        [
            f"SELECT '{c}' AS column_name, round(corr({TARGET}, {c}), 6) AS correlation FROM model"
            for c in columns
        ]
    )


ENGINEERED = """
           coalesce(len(string_split(all_property_types, ',')), 1) AS n_property_types,
           CASE WHEN third_party_certification IS NULL THEN 0 ELSE 1 END AS is_certified,
           CASE WHEN all_property_types ILIKE '%data center%' THEN 1 ELSE 0 END AS has_data_center"""

BASELINE = """
    , mid AS (SELECT quantile_cont(site_eui_gj_m2, 0.5) AS m FROM split WHERE NOT is_test),
    p AS (SELECT *, site_eui_gj_m2 AS actual, m AS predicted FROM split, mid WHERE is_test),
    score AS (
        SELECT count(*) AS n, avg(abs(actual - predicted)) AS mae,
               sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
               1 - sum((actual - predicted) * (actual - predicted))
                   / sum((actual - a) * (actual - a)) AS r2
        FROM p, (SELECT avg(actual) AS a FROM p))"""


REPORT = f"""WITH {TABLES}, predictions AS ({views.PREDICTIONS}),
    results AS (
        SELECT sequence, feature_set, model_name, concat(model_name, ' (', feature_set, ')') AS label,
               count(*) AS n, avg(abs(actual - predicted)) AS mae,
               sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
               1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual) AS r2
        FROM predictions GROUP BY ALL)"""
SCORES = "round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2"


def split_query(source: str, key: str) -> str:
    return f"""
    SELECT {key}, row_number() OVER (ORDER BY md5(concat('42:', {key})), {key})
                  <= ceil(0.2 * count(*) OVER ()) AS is_test
    FROM {source}"""


def statements() -> dict[str, str]:
    model_types = {
        **dict.fromkeys(BUILDING_COLUMNS, "string"),
        "reporting_year": "int",
        **dict.fromkeys(MEASURES, "double"),
        "energy_star_score": "int",
    }
    clean_measures = ", ".join(
        f"{lenient(raw)} AS {name}" for raw, name in zip(views.RAW_MEASURES, MEASURES, strict=True)
    )
    key = "replace(EWRB_ID, '�', '') AS ewrb_id"
    clean_building_columns = f"""{key}, City AS city, Postal_Code AS postal_code,
        PrimPropTypCalc AS primary_property_type, PrimPropTypSelf AS self_property_type,
        Largest_PropTyp AS largest_property_type, All_Prop_Types AS all_property_types,
        nullif(Thrd_Party_Cert, 'Not Available') AS third_party_certification"""
    score_text = "nullif(Ener_Star_Score, 'Not Available')"
    broken = f"WITH {TABLES}, broken AS ({views.BROKEN_ENERGY})"
    all_lines = "lineitem"
    gapped = """(SELECT l_orderkey, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS l_linenumber,
                        l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity,
                        l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)"""
    profiled = ["City", "Postal_Code", "PrimPropTypCalc", "PrimPropTypSelf", "Largest_PropTyp", "Thrd_Party_Cert"]
    pairs = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]]
    p, s, g = "primary_property_type", "self_property_type", "largest_property_type"
    match = lambda condition: f"100.0e0 * count(*) FILTER ({condition}) / count(*)"
    categorical = [p, s, g, "city", "postal_code"]
    known_in_train = " + ".join(
        f"""CASE WHEN coalesce({c}, '') IN (SELECT coalesce({c}, '') FROM split WHERE NOT is_test)
            THEN 1 ELSE 0 END"""
        for c in categorical
    )
    width = " + ".join(f"count(DISTINCT coalesce({c}, ''))" for c in categorical)
    joined_source = f"""buildings_energy"""
    joined_prefix = f"""WITH {TABLES}, buildings_energy AS (
        SELECT b.primary_property_type, e.{TARGET} FROM {JOINED})"""

    return {
        "q01_mean_eui_by_type": with_tables(f"""
            SELECT b.primary_property_type, {rounded_mean(f"e.{TARGET}", 2)} AS avg_site_eui,
                   count(*) AS building_count
            FROM {JOINED} GROUP BY b.primary_property_type"""),
        "q02_top_ghg_buildings": top_ghg("FIRST"),
        "q02b_top_ghg_nulls_last": top_ghg("LAST"),
        "q03_mean_water_by_city": with_tables(f"""
            SELECT b.city, {rounded_mean("e.water_intensity_m3_m2", 2)} AS avg_water_intensity
            FROM {JOINED} GROUP BY b.city"""),
        "q04_buildings_by_type": with_tables("""
            SELECT primary_property_type, count(*) AS num_buildings FROM buildings GROUP BY 1"""),
        "q05_mean_score_by_type": with_tables(f"""
            SELECT b.primary_property_type, {rounded_mean("e.energy_star_score", 1)} AS avg_star_score,
                   count(e.energy_star_score) AS scored_buildings
            FROM {JOINED} WHERE e.energy_star_score IS NOT NULL GROUP BY b.primary_property_type"""),
        "q06_weather_gap": with_tables(f"""
            SELECT b.ewrb_id, b.city, e.{TARGET}, e.weather_normalized_site_eui_gj_m2,
                   {rounded_number(f"(e.{TARGET} - e.weather_normalized_site_eui_gj_m2)", 2)} AS diff
            FROM {JOINED}
            WHERE e.{TARGET} IS NOT NULL AND e.weather_normalized_site_eui_gj_m2 IS NOT NULL"""),
        "q07_missing_readings": with_tables(f"""
            SELECT b.ewrb_id, b.city, b.primary_property_type, e.reporting_year,
                   e.gas_intensity_gj_m2, e.water_intensity_m3_m2
            FROM {JOINED}
            WHERE e.gas_intensity_gj_m2 IS NULL OR e.water_intensity_m3_m2 IS NULL"""),
        "q08_efficiency_tiers": with_tables(f"""
            SELECT b.ewrb_id, b.primary_property_type, e.energy_star_score,
                   CASE WHEN e.energy_star_score IS NULL THEN 'Unscored'
                        WHEN e.energy_star_score < 50 THEN 'Low Performer'
                        WHEN e.energy_star_score < 75 THEN 'Average'
                        ELSE 'High Performer' END AS efficiency_tier
            FROM {JOINED}"""),
        "q09_cities_above_mean": with_tables(f"""
            SELECT b.city, {rounded_mean("e.ghg_intensity_kgco2e_m2", 2)} AS city_avg_ghg
            FROM {JOINED} GROUP BY b.city
            HAVING avg(e.ghg_intensity_kgco2e_m2)
                   > (SELECT avg(ghg_intensity_kgco2e_m2) FROM energy_performance)"""),
        "q10_rank_in_type": rank_query(),
        "q10b_rank_in_large_type": rank_query(),
        "scan_buildings": with_tables("SELECT * FROM buildings"),
        "scan_energy": with_tables("SELECT * FROM energy_performance"),
        "sql_text": with_tables(f"""
            SELECT b.city, count(*) AS n_rows, max(e.reporting_year) AS last_year
            FROM {JOINED} GROUP BY b.city"""),
        "parquet_round_trip": with_tables("SELECT * FROM energy_performance"),
        "csv_export": with_model(f"SELECT {', '.join(MODEL_COLUMNS)} FROM model"),
        "raw_csv_clean": with_raw(f"SELECT {clean_building_columns} FROM raw"),
        "keep_first_line": first_lines(all_lines),
        "insert_if_absent": first_lines("(SELECT * FROM lineitem WHERE l_orderkey % 2 = 1)"),
        "insert_with_missing_keys": f"""
            SELECT * FROM ({first_lines(gapped)}) WHERE l_linenumber IS NOT NULL AND l_orderkey % 2 = 1
            UNION ALL SELECT * FROM {gapped} WHERE l_linenumber IS NULL""",
        "load_twice": with_tables("""
            SELECT reporting_year, count(*) AS n_energy,
                   cast(sum(energy_star_score) AS bigint) AS sum_score,
                   count(*) AS n_ids, (SELECT count(*) FROM buildings) AS n_buildings,
                   (SELECT count(*) FROM energy_performance) AS largest_id
            FROM energy_performance GROUP BY reporting_year"""),
        "dense_ids": with_tables("""
            SELECT row_number() OVER (ORDER BY ewrb_id, reporting_year) AS performance_id,
                   ewrb_id, reporting_year FROM energy_performance"""),
        "running_ids": with_tables("""
            SELECT count(*) AS n_rows, count(*) AS n_ids, true AS positive FROM energy_performance"""),
        "clean_buildings": with_raw(f"SELECT {clean_building_columns} FROM raw"),
        "clean_energy": with_raw(f"""
            SELECT {key}, cast(2024 AS int) AS reporting_year, {clean_measures},
                   {whole(score_text)} AS energy_star_score FROM raw"""),
        "raw_parquet_clean": with_raw(f"""
            SELECT {key}, cast(2024 AS int) AS reporting_year, {clean_measures},
                   {whole(score_text)} AS energy_star_score FROM raw"""),
        "clean_scores_lenient": with_raw(
            f"SELECT {key}, {whole(score_text)} AS energy_star_score FROM raw", True
        ),
        "rejected_scores": with_raw(f"""
            SELECT {key}, Ener_Star_Score AS score_text FROM raw
            WHERE {score_text} IS NOT NULL AND {whole(score_text)} IS NULL""", True),
        "duplicate_rows": f"""
            WITH twice AS (SELECT * FROM {gapped} UNION ALL
                           SELECT {LINE_COLUMNS} FROM lineitem WHERE l_partkey % 5 = 0)
            SELECT (SELECT count(*) FROM twice) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice))
                   AS duplicate_rows""",
        "length_violations": with_tables(union_of(
            [
                f"""SELECT '{c}' AS column_name, cast({n} AS int) AS max_length,
                    count(*) FILTER (length({c}) > {n}) AS violations FROM buildings"""
                for c, n in (("ewrb_id", 3), ("city", 8), (p, 9))
            ]
        )),
        "nan_to_null": with_tables(f"""
            SELECT ewrb_id, energy_star_score, reporting_year, {", ".join(
                f"CASE WHEN reporting_year <> {1995 + k % 7} THEN {c} END AS {c}" for k, c in enumerate(MEASURES)
            )} FROM energy_performance"""),
        "quality_report": with_tables(rule_rows("buildings", "energy_performance", 2000, 2100)),
        "quality_report_missing_columns": with_tables(
            rule_rows("buildings", "energy_performance", 2000, 2100, 2, 1)
        ),
        "quality_report_broken": f"{broken} {rule_rows('buildings', 'broken', 1996, 2000)}",
        "orphan_rows": f"""{broken}
            SELECT count(*) FILTER (e.ewrb_id IS NOT NULL AND b.ewrb_id IS NULL) AS orphan_rows,
                   count(*) FILTER (e.ewrb_id IS NULL) AS rows_without_key
            FROM broken e LEFT JOIN buildings b ON b.ewrb_id = e.ewrb_id""",
        "repeated_line_keys": """
            SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows
            FROM lineitem""",
        "one_row_per_building": with_model("""
            SELECT count(*) AS n_rows, count(DISTINCT ewrb_id) AS n_keys,
                   count(*) = count(DISTINCT ewrb_id) AS one_row_per_key FROM model"""),
        "model_dataset": with_model(f"SELECT {', '.join(MODEL_COLUMNS)} FROM model"),
        "latest_year_rows": f"""{broken}
            SELECT * FROM broken WHERE ewrb_id IS NOT NULL AND reporting_year IS NOT NULL
            QUALIFY rank() OVER (PARTITION BY ewrb_id ORDER BY reporting_year DESC) = 1""",
        "dropped_rows": with_model(f"""
            SELECT count(*) AS n_before, count({TARGET}) AS n_after,
                   count(*) - count({TARGET}) AS n_dropped FROM model"""),
        "shape_and_types": with_model(union_of(
            [
                f"""SELECT '{c}' AS column_name, cast({i} AS int) AS position, '{kind}' AS data_type,
                    count(*) AS n_rows, cast(19 AS int) AS n_columns FROM model"""
                for i, (c, kind) in enumerate(model_types.items(), start=1)
            ]
        )),
        "missing_summary": with_model("SELECT * FROM (" + union_of(
            [
                f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,
                    round_even(100.0e0 * (count(*) - count({c})) / count(*), 1) AS missing_pct FROM model"""
                for c in MODEL_COLUMNS
            ]
        ) + ") WHERE missing_count > 0"),
        "missing_target": with_model(f"""
            SELECT '{TARGET}' AS column_name, count(*) - count({TARGET}) AS missing_count,
                   round_even(100.0e0 * (count(*) - count({TARGET})) / count(*), 1) AS missing_pct
            FROM model"""),
        "describe_target": describe("model", f"WITH {MODEL}"),
        "describe_large_target": describe("energy_performance", f"WITH {TABLES}"),
        "price_quantiles_by_flag": PRICE_QUANTILES,
        "price_quantiles_by_large_flag": PRICE_QUANTILES,
        "type_counts": with_model(f"""
            SELECT {g}, count(*) AS n_rows FROM model WHERE {g} IS NOT NULL GROUP BY 1"""),
        "year_counts": with_model("SELECT reporting_year, count(*) AS n_rows FROM model GROUP BY 1"),
        "top_types": with_model(f"""
            SELECT {s}, count(*) AS n_rows FROM model GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
        "string_profile": with_raw(union_of(
            [
                f"""SELECT '{c}' AS column_name, cast(max(length({c})) AS int) AS max_length,
                    (SELECT min(sheet_row) FROM raw
                     WHERE length({c}) = (SELECT max(length({c})) FROM raw)) AS first_row,
                    (SELECT {c} FROM raw WHERE length({c}) = (SELECT max(length({c})) FROM raw)
                     ORDER BY sheet_row LIMIT 1) AS longest_value,
                    count(*) - count({c}) AS missing_count FROM raw"""
                for c in profiled
            ]
        )),
        "property_match_rates": with_model(union_of(
            [
                f"SELECT '{label}' AS comparison, round({match(condition)}, 6) AS match_pct, count(*) AS n_rows FROM model"
                for label, condition in (
                    (f"{p} = {s}", f"{p} = {s}"),
                    (f"{p} = {g}", f"{p} = {g}"),
                    (f"{s} = {g}", f"{s} = {g}"),
                    ("all", f"{p} = {s} AND {p} = {g}"),
                )
            ]
        )),
        "iqr_summary": with_model(f""", {FENCES}
            SELECT count({TARGET}) AS n_values, round(any_value(lo), 6) AS lower_bound,
                   round(any_value(hi), 6) AS upper_bound,
                   (SELECT count(*) FROM outside) AS n_outliers,
                   round(100.0e0 * (SELECT count(*) FROM outside) / count({TARGET}), 6) AS outlier_pct
            FROM model, f"""),
        "iqr_outliers": with_model(f", {FENCES} SELECT * FROM outside"),
        "largest_outliers": with_model(f""", {FENCES}
            SELECT * FROM outside ORDER BY {TARGET} DESC, ewrb_id LIMIT 10"""),
        "hist_equal_width": histogram_query(EQUAL_EDGES, f"{TARGET} IS NOT NULL"),
        "hist_log": histogram_query(LOG_EDGES, f"{TARGET} > 0"),
        "box_stats_by_type": box_query(p, 8, f"{TARGET} > 0", f"WITH {MODEL}", "model"),
        "box_stats_by_city": box_query("city", 10, f"{TARGET} IS NOT NULL", f"WITH {MODEL}", "model"),
        "box_stats_by_large_type": box_query(
            p, 3, f"{TARGET} IS NOT NULL", joined_prefix, joined_source
        ),
        "box_fliers_by_type": f"""WITH {MODEL}, {box_parts(p, 8, f"{TARGET} > 0", "model")}
            SELECT ewrb_id, {p}, {TARGET} FROM picked JOIN q USING ({p})
            WHERE {TARGET} < q1 - 1.5 * (q3 - q1) OR {TARGET} > q3 + 1.5 * (q3 - q1)""",
        "target_correlations": with_model(correlations([c for c in NUMBERS if c != TARGET])),
        "correlation_pairs": with_model(union_of(
            [
                f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation
                    FROM model"""
                for a, b in pairs
            ]
        )),
        "leakage_watchlist": with_model(correlations(
            [
                "source_eui_gj_m2",
                "weather_normalized_site_eui_gj_m2",
                "weather_normalized_source_eui_gj_m2",
                "electricity_intensity_gj_m2",
                "gas_intensity_gj_m2",
            ]
        )),
        "engineered_features": with_model(f"""
            SELECT ewrb_id, cast(n_property_types AS int) AS n_property_types, is_certified,
                   has_data_center FROM (SELECT ewrb_id, {ENGINEERED} FROM model)"""),
        "feature_summary": with_known(f""", f AS (SELECT {ENGINEERED} FROM known)
            SELECT cast(min(n_property_types) AS int) AS min_types,
                   cast(max(n_property_types) AS int) AS max_types,
                   round(avg(n_property_types), 6) AS mean_types,
                   count(*) FILTER (is_certified = 0) AS not_certified,
                   count(*) FILTER (is_certified = 1) AS certified,
                   count(*) FILTER (has_data_center = 0) AS without_data_center,
                   count(*) FILTER (has_data_center = 1) AS with_data_center FROM f"""),
        "feature_set_v1": with_known(f"SELECT ewrb_id, {', '.join(categorical)}, {TARGET} FROM known"),
        "feature_set_v2": with_known(f"""
            SELECT ewrb_id, {', '.join(categorical)}, cast(n_property_types AS int) AS n_property_types,
                   is_certified, has_data_center, {TARGET}
            FROM (SELECT *, {ENGINEERED} FROM known)"""),
        "hash_split": with_split("SELECT ewrb_id, is_test FROM split"),
        "exact_split": with_known(split_query("known", "ewrb_id")),
        "exact_split_large": split_query("orders", "o_orderkey"),
        "frequent_key_join": """
            SELECT l_orderkey, l_linenumber, key, s_name
            FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS key FROM lineitem) l
            JOIN supplier ON s_suppkey = key""",
        "report_scores": f"{REPORT} SELECT sequence, feature_set, model_name, n, {SCORES}, label FROM results",
        "report_best": f"""{REPORT}
            SELECT 'mae' AS metric, arg_min(label, (mae, sequence)) AS label, round(min(mae), 6) AS value,
                   true AS is_primary FROM results
            UNION ALL SELECT 'rmse', arg_min(label, (rmse, sequence)), round(min(rmse), 6), false FROM results
            UNION ALL SELECT 'r2', arg_min(label, (-r2, sequence)), round(max(r2), 6), false FROM results""",
        "report_comparison": f"""{REPORT}
            SELECT a.model_name, {", ".join(
                f"round(a.{m}, 6) AS {m}_v1, round(b.{m}, 6) AS {m}_v2, round(b.{m} - a.{m}, 6) AS {m}_change"
                for m in ("mae", "rmse", "r2")
            )} FROM results a JOIN results b ON a.model_name = b.model_name
            WHERE a.feature_set = 'v1' AND b.feature_set = 'v2'""",
        "report_largest_errors": f"""{REPORT}
            SELECT ewrb_id, city, primary_property_type, self_property_type, largest_property_type, postal_code,
                   round(actual, 6) AS actual, round(predicted, 6) AS predicted,
                   round(actual - predicted, 6) AS error, round(abs(actual - predicted), 6) AS absolute_error
            FROM predictions WHERE sequence = (SELECT arg_min(sequence, (mae, sequence)) FROM results)
            ORDER BY abs(actual - predicted) DESC, ewrb_id LIMIT 10""",
        "exact_split_missing_key": f"""
            WITH keyed AS (SELECT CASE WHEN o_orderkey <> 7 THEN o_orderkey END AS o_orderkey FROM orders),
            hashed AS (SELECT o_orderkey, coalesce(md5('42:' || o_orderkey), md5('42')) AS h FROM keyed)
            SELECT o_orderkey, row_number() OVER (ORDER BY h, o_orderkey) <= ceil(0.2 * count(*) OVER ())
                   AS is_test FROM hashed""",
        "quantiles_with_infinities": ODD_QUANTILES,
        "quantiles_with_infinities_large": ODD_QUANTILES,
        "label_check": with_split(f"""
            SELECT is_test, count(*) AS n_rows, count(*) - count({TARGET}) AS missing_labels
            FROM split GROUP BY is_test"""),
        "onehot_features": with_split(f"""
            SELECT ewrb_id, (SELECT {width} FROM split WHERE NOT is_test) AS width,
                   cast({known_in_train} AS bigint) AS n_known
            FROM split WHERE is_test"""),
        "median_baseline_metrics": with_split(f"""{BASELINE}
            SELECT n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2 FROM score"""),
        "largest_errors_baseline": with_split(f"""{BASELINE}
            SELECT ewrb_id, city, {p}, {s}, {g}, postal_code, round(actual, 6) AS actual,
                   round(predicted, 6) AS predicted, round(actual - predicted, 6) AS error,
                   round(abs(actual - predicted), 6) AS absolute_error
            FROM p ORDER BY abs(actual - predicted) DESC, ewrb_id LIMIT 10"""),
        "csv_line_breaks": "SELECT doc_id, text, lang FROM documents",
        "forest_training_means": with_split(f"""
            , rows AS (SELECT *, {ENGINEERED} FROM split WHERE NOT is_test)
            SELECT ewrb_id, round(avg({TARGET}) OVER (
                PARTITION BY {', '.join(categorical)}, n_property_types, is_certified, has_data_center), 6) AS predicted
            FROM rows"""),
        "least_squares_metrics": with_split(f"""
            , rows AS (SELECT *, {ENGINEERED} FROM split),
            means AS (SELECT primary_property_type AS kind, avg({TARGET}) AS predicted FROM rows WHERE NOT is_test GROUP BY 1),
            line AS (SELECT regr_slope({TARGET}, n_property_types) AS b, regr_intercept({TARGET}, n_property_types) AS a
                     FROM rows WHERE NOT is_test),
            p AS (
                SELECT 'category' AS features, {TARGET} AS actual, m.predicted
                FROM rows JOIN means m ON rows.primary_property_type IS NOT DISTINCT FROM m.kind WHERE is_test
                UNION ALL
                SELECT 'number', {TARGET}, a + b * n_property_types FROM rows, line WHERE is_test)
            SELECT features, count(*) AS n, round(avg(abs(actual - predicted)), 6) AS mae,
                   round(sqrt(avg((actual - predicted) ** 2)), 6) AS rmse,
                   round(1 - avg((actual - predicted) ** 2) / var_pop(actual), 6) AS r2
            FROM p GROUP BY 1"""),
        "baseline_consistency": with_split(f"""{BASELINE}
            SELECT 'Median Baseline' AS model_name, round(mae, 6) AS mae_v1, round(mae, 6) AS mae_v2,
                   round(rmse, 6) AS rmse_v1, round(rmse, 6) AS rmse_v2,
                   round(r2, 6) AS r2_v1, round(r2, 6) AS r2_v2, true AS consistent FROM score"""),
    }
