"""The analysis queries over buildings and their yearly measures.

`buildings` has one row per key; `energy` has one row per key and year. Sort orders name
their NULL placement and end in a tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions.scalar import round_half_away
from meterlark.operators.ranking import MAX_ROWS_PER_TASK, rank_within, top_k_matched

PRIMARY_TYPE = "primary_property_type"
GHG = "ghg_intensity_kgco2e_m2"
GAS = "gas_intensity_gj_m2"
WATER = "water_intensity_m3_m2"
NORMALIZED = "weather_normalized_site_eui_gj_m2"

# Lower score bounds of the tiers, highest first.
TIERS = ((75, "High Performer"), (50, "Average"))
NO_SCORE, LOWEST_TIER = "Unscored", "Low Performer"


def join_buildings(buildings: DataFrame, energy: DataFrame, attributes: list[str]) -> DataFrame:
    """Each measure row with the chosen attributes of its building."""
    return energy.join(buildings.select(S.KEY, *attributes), S.KEY)


def totals_by_group(
    buildings: DataFrame, energy: DataFrame, group: str, value: str
) -> DataFrame:
    """Per group of buildings: `n_rows`, `n_values`, and `total` of a measure.

    Measures are added up per building first. The join then moves one row per building, a
    building with very many rows is no hot key, and the join needs no further shuffle of
    that side because it is already placed by the key.
    """
    per_building = energy.where(F.col(S.KEY).isNotNull()).groupBy(S.KEY).agg(
        F.count("*").alias("n_rows"),
        F.count(value).alias("n_values"),
        F.sum(value).alias("total"),
    )
    return join_buildings(buildings, per_building, [group]).groupBy(group).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.sum("total").alias("total"),
    )


def _mean() -> Column:
    return F.try_divide(F.col("total"), F.col("n_values"))


def _largest_first(df: DataFrame, value: str, *ties: str) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in ties])


def mean_eui_by_type(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q1: mean site intensity and number of measure rows per property type."""
    result = totals_by_group(buildings, energy, PRIMARY_TYPE, S.TARGET).select(
        PRIMARY_TYPE,
        round_half_away(_mean(), 2).alias("avg_site_eui"),
        F.col("n_rows").alias("building_count"),
    )
    return _largest_first(result, "avg_site_eui", PRIMARY_TYPE)


def top_ghg_buildings(
    buildings: DataFrame, energy: DataFrame, k: int = 10, nulls: str = "first"
) -> DataFrame:
    """Q2: the `k` rows with the highest carbon intensity. Missing values lead, unless `nulls="last"`."""
    parents = buildings.select(S.KEY, "city", PRIMARY_TYPE)
    facts = energy.select(S.KEY, S.YEAR, GHG)
    return top_k_matched(facts, parents, S.KEY, GHG, k, [S.KEY, S.YEAR], nulls).drop(S.YEAR)


def mean_water_by_city(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q3: mean water intensity per city."""
    result = totals_by_group(buildings, energy, "city", WATER).select(
        "city", round_half_away(_mean(), 2).alias("avg_water_intensity")
    )
    return _largest_first(result, "avg_water_intensity", "city")


def buildings_by_type(buildings: DataFrame) -> DataFrame:
    """Q4: number of buildings per property type; a missing type is a group."""
    result = buildings.groupBy(PRIMARY_TYPE).agg(F.count("*").alias("num_buildings"))
    return _largest_first(result, "num_buildings", PRIMARY_TYPE)


def mean_score_by_type(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q5: mean score and number of scored rows per property type."""
    scored = energy.where(F.col(S.SCORE).isNotNull())
    result = totals_by_group(buildings, scored, PRIMARY_TYPE, S.SCORE).select(
        PRIMARY_TYPE,
        round_half_away(_mean(), 1).alias("avg_star_score"),
        F.col("n_values").alias("scored_buildings"),
    )
    return _largest_first(result, "avg_star_score", PRIMARY_TYPE)


def weather_gap(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q6: site intensity minus its weather-normalized form, where both are known."""
    known = energy.where(F.col(S.TARGET).isNotNull() & F.col(NORMALIZED).isNotNull())
    gap = round_half_away(F.col(S.TARGET) - F.col(NORMALIZED), 2)
    result = join_buildings(buildings, known, ["city"]).select(
        S.KEY, "city", S.TARGET, NORMALIZED, gap.alias("diff")
    )
    return _largest_first(result, "diff", S.KEY)


def missing_readings(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q7: building-years without a gas or without a water reading."""
    incomplete = energy.where(F.col(GAS).isNull() | F.col(WATER).isNull())
    return join_buildings(buildings, incomplete, ["city", PRIMARY_TYPE]).select(
        S.KEY, "city", PRIMARY_TYPE, S.YEAR, GAS, WATER
    )


def tier(score: Column, tiers=TIERS) -> Column:
    """Name of the first tier whose bound the score reaches."""
    first_bound, first_name = tiers[0]
    chosen = F.when(score >= first_bound, first_name)
    for bound, name in tiers[1:]:
        chosen = chosen.when(score >= bound, name)
    return chosen.when(score.isNull(), NO_SCORE).otherwise(LOWEST_TIER)


def efficiency_tiers(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q8: efficiency tier of every row; rows without a score come last."""
    result = join_buildings(buildings, energy, [PRIMARY_TYPE]).select(
        S.KEY, PRIMARY_TYPE, S.SCORE, tier(F.col(S.SCORE)).alias("efficiency_tier")
    )
    return result.orderBy(F.col(S.SCORE).desc_nulls_last(), F.col(S.KEY).asc_nulls_last())


def cities_above_mean(buildings: DataFrame, energy: DataFrame) -> DataFrame:
    """Q9: cities whose mean carbon intensity exceeds the mean of all measure rows.

    The overall mean also counts rows without a building. It is a scalar subquery, so there
    is no join against it.
    """
    per_city = totals_by_group(buildings, energy, "city", GHG).select("city", _mean().alias("mean"))
    overall = energy.agg(F.avg(GHG)).scalar()
    result = per_city.where(F.col("mean") > overall).select(
        "city", round_half_away(F.col("mean"), 2).alias("city_avg_ghg")
    )
    return _largest_first(result, "city_avg_ghg", "city")


def rank_in_type(
    buildings: DataFrame, energy: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Q10: rank of each site intensity among the rows of its property type. Runs a job.

    The largest type is counted from one row per building, so the row-level join runs once.
    """
    measured = energy.where(F.col(S.TARGET).isNotNull())
    joined = join_buildings(buildings, measured, ["city", PRIMARY_TYPE]).select(
        S.KEY, "city", PRIMARY_TYPE, S.TARGET
    )
    per_building = measured.groupBy(S.KEY).agg(F.count("*").alias("n"))
    per_type = join_buildings(buildings, per_building, [PRIMARY_TYPE]).groupBy(PRIMARY_TYPE)
    largest = per_type.agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    ranked = rank_within(joined, PRIMARY_TYPE, S.TARGET, "eui_rank_in_type", max_rows, largest)
    return ranked.orderBy(
        F.col(PRIMARY_TYPE).asc_nulls_last(), F.col("eui_rank_in_type").asc(), F.col(S.KEY).asc()
    )
