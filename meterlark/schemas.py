"""Table schemas, raw column names and rule bounds of the energy-benchmarking data."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

KEY = "ewrb_id"
YEAR = "reporting_year"
TARGET = "site_eui_gj_m2"
SCORE = "energy_star_score"

# Raw sheet column -> table column.
BUILDING_COLUMNS = {
    "EWRB_ID": "ewrb_id",
    "City": "city",
    "Postal_Code": "postal_code",
    "PrimPropTypCalc": "primary_property_type",
    "PrimPropTypSelf": "self_property_type",
    "Largest_PropTyp": "largest_property_type",
    "All_Prop_Types": "all_property_types",
    "Thrd_Party_Cert": "third_party_certification",
}
MEASURE_COLUMNS = {
    "WN_Sit_Elc_Int1": "electricity_intensity_gj_m2",
    "WN_Sit_Gas_Int1": "gas_intensity_gj_m2",
    "All_Water_Int1": "water_intensity_m3_m2",
    "Ind_Water_Int1": "indoor_water_intensity_m3_m2",
    "Site_EUI1": "site_eui_gj_m2",
    "WN_Site_EUI1": "weather_normalized_site_eui_gj_m2",
    "Source_EUI1": "source_eui_gj_m2",
    "WN_Source_EUI1": "weather_normalized_source_eui_gj_m2",
    "GHG_Emiss_Int1": "ghg_intensity_kgco2e_m2",
}
RAW_KEY = "EWRB_ID"
RAW_SCORE = "Ener_Star_Score"
RAW_CERTIFICATION = "Thrd_Party_Cert"
RAW_PROFILE_COLUMNS = [
    "City",
    "Postal_Code",
    "PrimPropTypCalc",
    "PrimPropTypSelf",
    "Largest_PropTyp",
    "Thrd_Party_Cert",
]

# The text that stands for a missing entry, and the stray character in keys.
MISSING_TEXT = "Not Available"
REPLACEMENT_CHARACTER = "�"

# Length limits of the text columns.
TEXT_LIMITS = {
    "ewrb_id": 10,
    "city": 30,
    "postal_code": 10,
    "primary_property_type": 50,
    "self_property_type": 50,
    "largest_property_type": 50,
    "third_party_certification": 50,
}

PROPERTY_TYPES = ["primary_property_type", "self_property_type", "largest_property_type"]
MEASURES = list(MEASURE_COLUMNS.values())

# Measures that are close to the target and so may leak it.
WATCHLIST = [
    "source_eui_gj_m2",
    "weather_normalized_site_eui_gj_m2",
    "weather_normalized_source_eui_gj_m2",
    "electricity_intensity_gj_m2",
    "gas_intensity_gj_m2",
]

YEAR_RANGE = (2000, 2100)

BUILDINGS = StructType(
    [StructField(name, StringType(), name != KEY) for name in BUILDING_COLUMNS.values()]
)
ENERGY = StructType(
    [StructField(KEY, StringType()), StructField(YEAR, IntegerType())]
    + [StructField(name, DoubleType()) for name in MEASURES]
    + [StructField(SCORE, IntegerType())]
)
ENERGY_WITH_ID = StructType([StructField("performance_id", LongType(), False), *ENERGY.fields])


def raw_sheet(columns: list[str] | None = None) -> StructType:
    """All-text schema for the raw sheet, so that no value is guessed into another type."""
    names = columns or [*BUILDING_COLUMNS, *MEASURE_COLUMNS, RAW_SCORE]
    return StructType([StructField(name, StringType()) for name in names])
