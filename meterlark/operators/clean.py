"""Turn the raw all-text sheet into the two typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions import scalar as X


def clean_key(key: Column) -> Column:
    """Key as text without stray replacement characters. A missing key stays NULL."""
    return X.remove_text(key.cast("string"), S.REPLACEMENT_CHARACTER)


def clean_measure(text: Column) -> Column:
    return X.lenient_double(X.blank_to_null(text, S.MISSING_TEXT))


def clean_score(text: Column, strict: bool = True) -> Column:
    return X.whole_number(X.blank_to_null(text, S.MISSING_TEXT), strict)


def clean_buildings(raw: DataFrame) -> DataFrame:
    """One row of attributes per raw row. Only the certification column knows the missing-text marker."""
    return raw.select(*S.BUILDING_COLUMNS).withColumns(
        {
            S.RAW_KEY: clean_key(F.col(S.RAW_KEY)),
            S.RAW_CERTIFICATION: X.blank_to_null(F.col(S.RAW_CERTIFICATION), S.MISSING_TEXT),
        }
    ).withColumnsRenamed(S.BUILDING_COLUMNS)


def clean_energy(raw: DataFrame, year: int = 2024, strict: bool = True) -> DataFrame:
    """One row of measures per raw row, with the reporting year as second column."""
    measures = raw.select(S.RAW_KEY, *S.MEASURE_COLUMNS, S.RAW_SCORE).withColumns(
        {
            S.RAW_KEY: clean_key(F.col(S.RAW_KEY)),
            **{name: clean_measure(F.col(name)) for name in S.MEASURE_COLUMNS},
            S.RAW_SCORE: clean_score(F.col(S.RAW_SCORE), strict),
        }
    ).withColumnsRenamed({S.RAW_KEY: S.KEY, **S.MEASURE_COLUMNS, S.RAW_SCORE: S.SCORE})
    return measures.withColumn(S.YEAR, F.lit(year).cast("int")).select(*S.ENERGY.names)


def rejected_scores(raw: DataFrame) -> DataFrame:
    """Rows whose score text the strict cast would refuse."""
    text = X.blank_to_null(F.col(S.RAW_SCORE), S.MISSING_TEXT)
    return raw.where(text.isNotNull() & ~X.is_whole_number(text)).select(
        clean_key(F.col(S.RAW_KEY)).alias(S.KEY), F.col(S.RAW_SCORE).alias("score_text")
    )


def null_out_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    floats = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: X.nan_to_null(F.col(name)) for name in floats})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier row in all columns."""
    repeats = df.groupBy(*df.columns).agg((F.count("*") - 1).alias("extra"))
    return repeats.agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def length_violations(df: DataFrame, limits: dict[str, int] = S.TEXT_LIMITS) -> DataFrame:
    """Per limited column: the limit and how many values exceed it."""
    names = [name for name in limits if name in df.columns]
    counted = df.agg(*[F.count_if(F.length(name) > limits[name]).alias(name) for name in names])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(limits[name]).cast("int").alias("max_length"),
                        F.col(name).alias("violations"),
                    )
                    for name in names
                ]
            )
        )
    )


def enforce_lengths(df: DataFrame, limits: dict[str, int] = S.TEXT_LIMITS) -> DataFrame:
    """Raise while the rows are computed when a text is longer than its limit."""
    def checked(name: str) -> Column:
        value = F.col(name)
        refused = F.raise_error(F.lit(f"{name} is longer than {limits[name]}")).cast("string")
        return F.when(F.length(value) > limits[name], refused).otherwise(value)

    return df.withColumns({name: checked(name) for name in limits if name in df.columns})


def enforce_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Raise while the rows are computed when one of `names` is NULL."""
    return df.withColumns(
        {
            name: F.coalesce(
                F.col(name), F.raise_error(F.lit(f"{name} is missing")).cast(df.schema[name].dataType)
            )
            for name in names
        }
    )
