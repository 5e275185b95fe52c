"""Data-quality rules, each counted with aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlark import schemas as S


def extra_rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first per key, over rows whose key is complete."""
    groups = df.dropna(subset=list(keys)).groupBy(*keys).agg((F.count("*") - 1).alias("extra"))
    return groups.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def key_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, and whether both agree."""
    counts = df.groupBy(key).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(key).alias("n_keys"),
    )
    return counts.withColumn("one_row_per_key", F.col("n_rows") == F.col("n_keys"))


def orphan_summary(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: child rows without a parent, and child rows without a key.

    Child rows are counted per key first, so a frequent key reaches the join as one row.
    """
    counts = child.groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(key).alias("_parent")).dropna().distinct().withColumn("_known", F.lit(True))
    matched = counts.join(known, counts[key] == known["_parent"], "left")
    has_key = F.col(key).isNotNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return matched.agg(
        total(has_key & F.col("_known").isNull()).alias("orphan_rows"),
        total(~has_key).alias("rows_without_key"),
    )


def _rule(rule: str, table: str, violations: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        violations.cast("bigint").alias("violations"),
    )


def _completed(df: DataFrame, schema: StructType) -> DataFrame:
    absent = [field for field in schema if field.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def quality_report(
    buildings: DataFrame,
    energy: DataFrame,
    year_range: tuple[int, int] = S.YEAR_RANGE,
) -> DataFrame:
    """One row per rule: how many violations, and whether the rule holds.

    Each table is read once. Rows are counted per key and year, then per key, before the two
    tables meet in one full join with at most one row per key on either side.
    """
    absent_b = len(set(S.BUILDINGS.names) - set(buildings.columns))
    absent_e = len(set(S.ENERGY.names) - set(energy.columns))
    buildings, energy = _completed(buildings, S.BUILDINGS), _completed(energy, S.ENERGY)
    b_key = F.col("_building")
    e_key = F.col(S.KEY)
    per_building = buildings.groupBy(F.col(S.KEY).alias("_building")).agg(
        F.count("*").alias("b_rows")
    )
    per_year = energy.groupBy(S.KEY, S.YEAR).agg(
        F.count("*").alias("n"), F.count_if(F.col(S.TARGET) < 0).alias("negative")
    )
    complete = e_key.isNotNull() & F.col(S.YEAR).isNotNull()
    per_key = per_year.groupBy(S.KEY).agg(
        F.sum("n").alias("e_rows"),
        F.sum("negative").alias("negative"),
        F.sum(F.when(complete, F.col("n") - 1)).alias("repeated"),
        F.sum(F.when(~F.col(S.YEAR).between(*year_range), F.col("n"))).alias("odd_years"),
    )
    matched = per_building.join(per_key, b_key == e_key, "full")

    def total(count: Column, condition: Column | None = None) -> Column:
        counted = count if condition is None else F.when(condition, count)
        return F.coalesce(F.sum(counted), F.lit(0))

    b, e = "buildings", "energy_performance"
    b_rows, e_rows = F.col("b_rows"), F.col("e_rows")
    rules = F.array(
        _rule("expected_columns", b, F.lit(absent_b)),
        _rule("key_present", b, total(b_rows, b_key.isNull())),
        _rule("unique_key", b, total(b_rows - 1, b_key.isNotNull())),
        _rule("expected_columns", e, F.lit(absent_e)),
        _rule("target_not_negative", e, total(F.col("negative"))),
        _rule("year_in_range", e, total(F.col("odd_years"))),
        _rule("unique_key_and_year", e, total(F.col("repeated"))),
        _rule("building_exists", e, total(e_rows, e_key.isNotNull() & b_key.isNull())),
        _rule("key_present", e, total(e_rows, e_key.isNull())),
    )
    report = matched.agg(rules.alias("_rules")).select(F.inline("_rules"))
    return report.withColumn("passed", F.col("violations") == 0)
