"""Building-energy tables derived from the driver's tables, as SQL both engines run.

The driver's tables hold no NULLs, ties or dirty text, so the views add them by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUILDINGS = """
SELECT cast(c_custkey AS varchar(10)) AS ewrb_id,
       n_name AS city,
       concat('M', cast(c_nationkey % 10 AS varchar(2)), 'V') AS postal_code,
       c_mktsegment AS primary_property_type,
       CASE WHEN c_custkey % 13 = 0 THEN 'OTHER' ELSE c_mktsegment END AS self_property_type,
       CASE WHEN c_custkey % 29 = 0 THEN NULL
            WHEN c_custkey % 17 = 0 THEN 'OTHER'
            ELSE c_mktsegment END AS largest_property_type,
       CASE WHEN c_custkey % 31 = 0 THEN NULL
            ELSE concat(c_mktsegment,
                        CASE WHEN c_custkey % 3 = 0 THEN ',Parking' ELSE '' END,
                        CASE WHEN c_custkey % 11 = 0 THEN ',DATA Center' ELSE '' END)
       END AS all_property_types,
       CASE WHEN c_custkey % 50 = 0 THEN 'LEED' END AS third_party_certification
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

ENERGY = """
SELECT cast(k AS varchar(10)) AS ewrb_id,
       yr AS reporting_year,
       f / 100000 AS electricity_intensity_gj_m2,
       CASE WHEN (k + yr) % 5 <> 0 THEN tot / 200000 END AS gas_intensity_gj_m2,
       CASE WHEN (k + yr) % 7 <> 0 THEN n * 1.5e0 END AS water_intensity_m3_m2,
       CASE WHEN (k + yr) % 4 <> 0 THEN n * 0.75e0 END AS indoor_water_intensity_m3_m2,
       CASE WHEN (k + yr) % 19 = 0 THEN NULL
            WHEN k % 211 = 0 THEN cast(floor(tot / 10000) AS double) * 1000
            ELSE cast(floor(tot / 10000) AS double) / 10 END AS site_eui_gj_m2,
       CASE WHEN (k + yr) % 23 <> 0 THEN tot / 110000 END AS weather_normalized_site_eui_gj_m2,
       CASE WHEN (k + yr) % 13 <> 0 THEN tot / 60000 END AS source_eui_gj_m2,
       CASE WHEN (k + yr) % 13 <> 0 THEN tot / 62000 END AS weather_normalized_source_eui_gj_m2,
       CASE WHEN (k + yr) % 17 <> 0 THEN tot / 50000 + n END AS ghg_intensity_kgco2e_m2,
       CASE WHEN (k + yr) % 3 <> 0 THEN cast((k * 37 + yr) % 100 + 1 AS int) END AS energy_star_score
FROM (
    SELECT o_custkey AS k,
           cast(year(o_orderdate) AS int) AS yr,
           cast(sum(cast(o_totalprice AS decimal(18, 2))) AS double) AS tot,
           cast(sum(CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice AS decimal(18, 2)) END)
                AS double) AS f,
           cast(count(*) AS int) AS n
    FROM orders
    GROUP BY o_custkey, year(o_orderdate)
) AS yearly
"""

# Measures with seeded rule violations: unknown buildings, a missing key, negative targets,
# repeated key and year.
BROKEN_ENERGY = """
SELECT CASE WHEN cast(ewrb_id AS bigint) % 89 = 0 THEN NULL
            WHEN cast(ewrb_id AS bigint) % 97 = 0
            THEN cast(cast(ewrb_id AS bigint) + 1000000 AS varchar(10))
            ELSE ewrb_id END AS ewrb_id,
       CASE WHEN cast(ewrb_id AS bigint) % 41 = 0 THEN 2001 ELSE reporting_year END AS reporting_year,
       electricity_intensity_gj_m2, gas_intensity_gj_m2, water_intensity_m3_m2,
       indoor_water_intensity_m3_m2,
       CASE WHEN cast(ewrb_id AS bigint) % 37 = 0 THEN -1 - site_eui_gj_m2
            ELSE site_eui_gj_m2 END AS site_eui_gj_m2,
       weather_normalized_site_eui_gj_m2, source_eui_gj_m2, weather_normalized_source_eui_gj_m2,
       ghg_intensity_kgco2e_m2, energy_star_score
FROM energy_performance
"""


def _dirty_number(column: str, shift: int) -> str:
    c = f"(c_custkey + {shift})"
    return f"""
       CASE WHEN {c} % 10 = 0 THEN 'Not Available'
            WHEN {c} % 11 = 0 THEN '1.5d'
            WHEN {c} % 13 = 0 THEN '1_0'
            WHEN {c} % 17 = 0 THEN 'inf'
            WHEN {c} % 19 = 0 THEN ' 2.5e1 '
            WHEN {c} % 23 = 0 THEN ''
            WHEN {c} % 29 = 0 THEN NULL
            ELSE cast(cast(c_acctbal AS decimal(18, 2)) AS varchar(30)) END AS {column}"""


RAW_MEASURES = [
    "WN_Sit_Elc_Int1",
    "WN_Sit_Gas_Int1",
    "All_Water_Int1",
    "Ind_Water_Int1",
    "Site_EUI1",
    "WN_Site_EUI1",
    "Source_EUI1",
    "WN_Source_EUI1",
    "GHG_Emiss_Int1",
]


def raw_sheet(bad_scores: bool = False) -> str:
    """The wide all-text sheet. `bad_scores` adds score text that is no integer."""
    bad = "WHEN c_custkey % 7 = 0 THEN '75.5' WHEN c_custkey % 8 = 0 THEN 'abc'" if bad_scores else ""
    measures = ",".join(_dirty_number(name, at) for at, name in enumerate(RAW_MEASURES))
    return f"""
SELECT c_custkey AS sheet_row,
       CASE WHEN c_custkey % 40 = 0 THEN concat(cast(c_custkey AS varchar(10)), '�')
            ELSE cast(c_custkey AS varchar(10)) END AS EWRB_ID,
       CASE WHEN c_custkey % 60 = 0 THEN 'Not Available' ELSE n_name END AS City,
       concat('M', cast(c_nationkey % 10 AS varchar(2)), 'V') AS Postal_Code,
       c_mktsegment AS PrimPropTypCalc,
       CASE WHEN c_custkey % 13 = 0 THEN 'OTHER' ELSE c_mktsegment END AS PrimPropTypSelf,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_mktsegment END AS Largest_PropTyp,
       c_mktsegment AS All_Prop_Types,
       CASE WHEN c_custkey % 50 = 0 THEN 'LEED'
            WHEN c_custkey % 7 = 0 THEN NULL
            ELSE 'Not Available' END AS Thrd_Party_Cert,
       {measures},
       CASE WHEN c_custkey % 3 = 0 THEN 'Not Available'
            {bad}
            WHEN c_custkey % 5 = 0 THEN concat(cast(c_custkey % 100 + 1 AS varchar(10)), '.0')
            WHEN c_custkey % 11 = 0 THEN NULL
            ELSE cast(c_custkey % 100 + 1 AS varchar(10)) END AS Ener_Star_Score
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


# Given here so that no job has to look into the files for them.
SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


# Six experiments whose predictions are stated, each off by another share of the target.
PREDICTIONS = """
SELECT e.feature_set, e.model_name, e.sequence, b.ewrb_id, b.city, b.primary_property_type,
       b.self_property_type, b.largest_property_type, b.postal_code,
       m.site_eui_gj_m2 AS actual,
       CASE WHEN e.sequence IN (0, 100) THEN 9.5e0
            ELSE m.site_eui_gj_m2 * (1 + (cast(b.ewrb_id AS bigint) % 7 - 3) * e.off)
                 + (m.reporting_year - 1998) * e.off END AS predicted
FROM buildings b JOIN energy_performance m ON b.ewrb_id = m.ewrb_id
JOIN (SELECT 'v1' AS feature_set, 'Median Baseline' AS model_name, 0 AS sequence, 0e0 AS off
      UNION ALL SELECT 'v1', 'Linear Regression', 1, 5e-2
      UNION ALL SELECT 'v1', 'Random Forest', 2, 4e-2
      UNION ALL SELECT 'v2', 'Median Baseline', 100, 0e0
      UNION ALL SELECT 'v2', 'Linear Regression', 101, 45e-3
      UNION ALL SELECT 'v2', 'Random Forest', 102, 4e-2
      UNION ALL SELECT 'v2', 'Random Forest log1p', 104, 6e-2) e ON m.reporting_year < 9000 + e.sequence
WHERE m.site_eui_gj_m2 IS NOT NULL AND cast(b.ewrb_id AS bigint) % 5 = 0 AND m.reporting_year >= 2000
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    for name in tables:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **tables)


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(
        spark,
        BUILDINGS,
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, ENERGY, orders=table(spark, sf_dir, "orders"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(
        spark,
        PREDICTIONS,
        buildings=buildings(spark, sf_dir),
        energy_performance=energy(spark, sf_dir),
    )


def broken_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, BROKEN_ENERGY, energy_performance=energy(spark, sf_dir))


def raw(spark: SparkSession, sf_dir: str, bad_scores: bool = False) -> DataFrame:
    return _view(
        spark,
        raw_sheet(bad_scores),
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )
