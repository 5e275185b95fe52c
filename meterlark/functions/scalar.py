"""Column expressions shared by the operators. All of them are built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INT_RANGE = (-(2**31), 2**31 - 1)


def round_half_away(value: Column, digits: int) -> Column:
    """Round like SQL numeric: a double has 15 significant digits, and exact ties go away from zero.

    Values too wide for the decimal, NaN and the infinities pass through.
    """
    number = value.cast("double")
    exact = F.round(F.format_string("%.14e", number).try_cast("decimal(38,18)"), digits).cast("double")
    return F.coalesce(exact, number)


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def blank_to_null(value: Column, text: str) -> Column:
    """NULL for exactly `text`, case-sensitive."""
    return F.nullif(value, F.lit(text))


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and the infinities."""
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def lenient_double(text: Column) -> Column:
    """Number in `text`, or NULL when it is none. Never an error."""
    return finite_or_null(F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double")))


def is_whole_number(text: Column) -> Column:
    """True when `text` holds an integer of 32 bits, also when written like `75.0`."""
    number = lenient_double(text)
    return F.coalesce((number == F.floor(number)) & number.between(*INT_RANGE), F.lit(False))


def whole_number(text: Column, strict: bool = True) -> Column:
    """Integer in `text`; text that is no integer raises when `strict`, else gives NULL."""
    parsed = F.when(is_whole_number(text), lenient_double(text).try_cast("int"))
    if not strict:
        return parsed
    refused = F.raise_error(F.concat(F.lit("not an integer: "), text)).cast("int")
    return F.when(text.isNotNull() & ~is_whole_number(text), refused).otherwise(parsed)


def remove_text(value: Column, text: str) -> Column:
    return F.replace(value, F.lit(text), F.lit(""))


def list_length(text: Column, separator: str = ",") -> Column:
    """Number of entries in a separated list; a missing or empty list counts as one entry."""
    return F.coalesce(F.size(F.split(text, separator)), F.lit(1))


def contains_ignoring_case(text: Column, phrase: str) -> Column:
    """1 when `phrase` occurs in `text` in any case, else 0, also for NULL."""
    return F.coalesce(F.contains(F.lower(text), F.lit(phrase.lower())), F.lit(False)).cast("int")


def present_flag(value: Column) -> Column:
    return value.isNotNull().cast("int")


def is_close(a: Column, b: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def equal_rate(matches: Column) -> Column:
    """Percentage of all rows on which `matches` holds; NULL counts as no match."""
    return F.avg(F.when(matches, 100.0).otherwise(0.0))


def pearson(a: str, b: str) -> Column:
    """Correlation of two columns without NULLs; NULL when either is constant.

    `corr` would raise on a constant side under ANSI rules.
    """
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
