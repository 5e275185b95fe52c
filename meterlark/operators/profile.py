"""Profiling of a frame in as few passes as possible; every result is a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark.functions import scalar as X
from meterlark.operators.comoments import correlations
from meterlark.operators.quantiles import MAX_ROWS_PER_TASK, exact_quantiles

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _to_rows(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*entries)))


def shape_and_types(df: DataFrame) -> DataFrame:
    """Per column: its position and type, with the number of rows and columns."""
    counted = df.agg(F.count("*").alias("n_rows"))
    return _to_rows(
        counted,
        [
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(at).cast("int").alias("position"),
                F.lit(kind).alias("data_type"),
                F.col("n_rows"),
                F.lit(len(df.columns)).cast("int").alias("n_columns"),
            )
            for at, (name, kind) in enumerate(df.dtypes, start=1)
        ],
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        name
        for name, kind in df.dtypes
        if name not in exclude and (kind in NUMERIC_TYPES or kind.startswith("decimal"))
    ]


def missing_values(df: DataFrame, keep_complete: bool = False) -> DataFrame:
    """NULL count and percentage per column with any, most missing first."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    rows = _to_rows(
        counted,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col("_rows") - F.col(c)).alias("missing_count"),
                F.col("_rows").alias("_rows"),
            )
            for c in df.columns
        ],
    )
    if not keep_complete:
        rows = rows.where(F.col("missing_count") > 0)
    percent = F.try_divide(F.col("missing_count"), F.col("_rows")) * 100
    return rows.select(
        "column_name", "missing_count", X.round_half_even(percent, 1).alias("missing_pct")
    ).orderBy(F.col("missing_count").desc(), "column_name")


def missing_in(df: DataFrame, column: str) -> DataFrame:
    """NULL count and percentage of one column."""
    return missing_values(df.select(column), keep_complete=True)


def describe(df: DataFrame, value: str, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One row: count, mean, sample deviation, minimum, quartiles, median and maximum."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, max_rows=max_rows)
    packed = quartiles.select(F.struct("q1", "median", "q3")).scalar()
    x = F.col(value)
    return (
        df.agg(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
        .withColumn("_q", packed)
        .select("n", "mean", "std", "min", "_q.q1", "_q.median", "_q.q3", "max")
    )


def fences(df: DataFrame, value: str, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One row: quartiles and the bounds 1.5 interquartile ranges beyond them."""
    return with_fences(exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}, max_rows=max_rows))


def with_fences(quartiles: DataFrame) -> DataFrame:
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    return quartiles.withColumns(
        {"lower_bound": F.col("q1") - reach, "upper_bound": F.col("q3") + reach}
    )


def _with_bounds(df: DataFrame, value: str, max_rows: int) -> DataFrame:
    bounds = fences(df, value, max_rows).select(F.struct("lower_bound", "upper_bound")).scalar()
    return df.withColumn("_bounds", bounds)


def _outside(value: str) -> Column:
    x = F.col(value)
    return (x < F.col("_bounds.lower_bound")) | (x > F.col("_bounds.upper_bound"))


def outlier_summary(df: DataFrame, value: str, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One row: bounds, outlier count, and outlier percentage of the non-null values."""
    bounded = _with_bounds(df.select(value), value, max_rows)
    return bounded.agg(
        F.count(value).alias("n_values"),
        F.first("_bounds.lower_bound").alias("lower_bound"),
        F.first("_bounds.upper_bound").alias("upper_bound"),
        F.count_if(_outside(value)).alias("n_outliers"),
    ).withColumn("outlier_pct", F.try_divide(F.col("n_outliers"), F.col("n_values")) * 100)


def outliers(df: DataFrame, value: str, columns: Sequence[str], max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """All rows outside the bounds, with the chosen columns."""
    wanted = df.select(*dict.fromkeys([*columns, value]))
    return _with_bounds(wanted, value, max_rows).where(_outside(value)).drop("_bounds")


def largest_outliers(
    df: DataFrame, value: str, columns: Sequence[str], k: int = 10, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    found = outliers(df, value, columns, max_rows)
    return found.orderBy(F.col(value).desc(), *columns).limit(k)


def _correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Correlation of each pair over the rows where both sides are present, in one pass.

    Each task sums all pairs at once and hands on one row per pair, see `comoments`.
    """
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    measured = correlations(df, pairs)
    by_pair = measured.agg(
        F.map_from_entries(F.collect_list(F.struct("pair", "correlation"))).alias("_r")
    )
    return _to_rows(
        by_pair,
        [
            F.struct(
                F.lit(a).alias("column_a"),
                F.lit(b).alias("column_b"),
                F.try_element_at("_r", F.lit(i)).alias("correlation"),
            )
            for i, (a, b) in enumerate(pairs)
        ],
    )


def target_correlations(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Correlation of the target with each other numeric column, strongest first."""
    others = [c for c in numeric_columns(df, exclude) if c != target]
    rows = _correlations(df, [(target, c) for c in others])
    return rows.select(F.col("column_b").alias("column_name"), "correlation").orderBy(
        F.abs("correlation").desc_nulls_last(), "column_name"
    )


def watchlist_correlations(df: DataFrame, target: str, watchlist: Sequence[str]) -> DataFrame:
    """Correlations of the listed columns only; the others are not computed."""
    listed = [c for c in watchlist if c in df.columns]
    return target_correlations(df.select(target, *listed), target)


def correlation_pairs(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Correlation of every pair of numeric columns, each pair once, in one pass."""
    names = numeric_columns(df, exclude)
    return _correlations(df, [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]])


def match_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Percentage of rows on which columns agree: each pair, then all of them."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    all_equal = F.lit(True)
    for other in columns[1:]:
        all_equal = all_equal & (F.col(columns[0]) == F.col(other))
    measured = df.agg(
        F.count("*").alias("n_rows"),
        *[X.equal_rate(F.col(a) == F.col(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)],
        X.equal_rate(all_equal).alias("all"),
    )
    entries = [(f"{a} = {b}", f"p{i}") for i, (a, b) in enumerate(pairs)] + [("all", "all")]
    return _to_rows(
        measured,
        [
            F.struct(F.lit(label).alias("comparison"), F.col(c).alias("match_pct"), F.col("n_rows"))
            for label, c in entries
        ],
    )


def text_profile(df: DataFrame, columns: Sequence[str], sequence: str) -> DataFrame:
    """Per text column: longest length, the first row that has it, its text, and NULL count.

    `sequence` is an integer column that gives the row order.
    """
    aggregates = []
    for c in columns:
        rank = F.when(F.col(c).isNotNull(), F.struct(F.length(c), -F.col(sequence)))
        aggregates.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.max(F.length(c)).cast("int").alias("max_length"),
                F.max_by(F.col(sequence), rank).cast("bigint").alias("first_row"),
                F.max_by(F.col(c), rank).alias("longest_value"),
                F.count_if(F.col(c).isNull()).alias("missing_count"),
            )
        )
    return df.agg(F.array(*aggregates).alias("_all")).select(F.inline("_all"))
