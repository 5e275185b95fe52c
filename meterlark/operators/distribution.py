"""Histograms and box statistics: the tables behind the distribution plots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark.operators.profile import with_fences
from meterlark.operators.quantiles import MAX_ROWS_PER_TASK, exact_quantiles
from meterlark.session import materialize


def _bounds(values: DataFrame, value: str) -> Column:
    return values.select(
        F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))
    ).scalar()


def _settled(value: Column, guess: Column, edge, last: int) -> Column:
    """Move a computed bin by one where rounding put the value on the wrong side of an edge."""
    lowered = F.when((guess > 0) & (value < edge(guess)), guess - 1).otherwise(guess)
    return F.when((lowered < last) & (value >= edge(lowered + 1)), lowered + 1).otherwise(lowered)


def _all_bins(values: DataFrame, bin_number: Column, edge, bounds: Column, n_bins: int) -> DataFrame:
    """Count per bin, including empty bins, with the bin edges."""
    counts = values.groupBy(bin_number.cast("bigint").alias("bin")).agg(F.count("*").alias("n"))
    bins = values.sparkSession.range(n_bins).withColumnRenamed("id", "bin").withColumn("_b", bounds)
    return bins.join(counts, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def equal_width_histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Counts in equal bins from the smallest to the largest value; the last bin is closed.

    A single distinct value gets a range of width one around it.
    """
    values = df.select(value).where(F.col(value).isNotNull())
    raw = _bounds(values, value)
    lo = F.col("_b.lo") - F.when(F.col("_b.lo") == F.col("_b.hi"), 0.5).otherwise(0.0)
    hi = F.col("_b.hi") + F.when(F.col("_b.lo") == F.col("_b.hi"), 0.5).otherwise(0.0)

    def edge(at: Column) -> Column:
        return F.when(at == bins, hi).otherwise(lo + at * ((hi - lo) / bins))

    x = F.col(value)
    guess = F.least(F.floor((x - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    number = _settled(x, guess, edge, bins - 1)
    return _all_bins(values.withColumn("_b", raw), number, edge, raw, bins)


def log_histogram(df: DataFrame, value: str, edges: int = 40) -> DataFrame:
    """Counts of the positive values between `edges` log-spaced edges, so one bin fewer.

    The outer edges are the smallest and largest value themselves: the rounded powers can
    miss them and drop a row.
    """
    last = edges - 1
    values = df.select(value).where(F.col(value) > 0)
    raw = _bounds(values, value)
    lo, hi = F.log10("_b.lo"), F.log10("_b.hi")
    step = (hi - lo) / last

    def edge(at: Column) -> Column:
        inner = F.least(F.greatest(F.pow(F.lit(10.0), lo + at * step), "_b.lo"), "_b.hi")
        return F.when(at == 0, F.col("_b.lo")).when(at == last, F.col("_b.hi")).otherwise(inner)

    x = F.col(value)
    share = F.coalesce(F.try_divide(F.log10(x) - lo, step), F.lit(float(last)))
    guess = F.greatest(F.least(F.floor(share), F.lit(last - 1)), F.lit(0))
    number = _settled(x, guess, edge, last - 1)
    return _all_bins(values.withColumn("_b", raw), number, edge, raw, last)


@dataclass(frozen=True)
class _Boxes:
    """The most frequent categories with their counts, their values, and their quartiles."""

    top: DataFrame
    values: DataFrame
    quartiles: DataFrame


def _boxes(
    df: DataFrame, category: str, value: str, top_n: int, positive_only: bool, max_rows: int
) -> _Boxes:
    """Reads `df` three times in all, so write an expensive one first."""
    x = F.col(value)
    usable = x > 0 if positive_only else x.isNotNull()
    counts = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count("*").alias("n_in_category"))
    top = counts.orderBy(F.col("n_in_category").desc(), F.col(category).asc()).limit(top_n)
    # Broadcast: at most top_n rows.
    top = F.broadcast(materialize(top, "top"))
    values = df.where(usable).join(top.select(category), category, "left_semi")
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    quartiles = exact_quantiles(values, value, wanted, [category], max_rows)
    return _Boxes(top, values, with_fences(quartiles))


def box_stats(
    df: DataFrame,
    category: str,
    value: str,
    top_n: int,
    positive_only: bool = False,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Box-plot numbers for the `top_n` most frequent categories.

    Whiskers end at the outermost values within 1.5 interquartile ranges of the box, and
    never inside the box. Values beyond them are counted as fliers.
    """
    boxes = _boxes(df, category, value, top_n, positive_only, max_rows)
    x = F.col(value)
    inside = x.between(F.col("lower_bound"), F.col("upper_bound"))
    whiskers = (
        boxes.values.join(F.broadcast(boxes.quartiles), category)
        .groupBy(category, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("_low"),
            F.max(F.when(inside, x)).alias("_high"),
            F.count_if(~inside).alias("n_fliers"),
        )
    )
    return boxes.top.join(F.broadcast(whiskers), category, "left").select(
        category,
        "n_in_category",
        F.coalesce("n", F.lit(0)).alias("n"),
        "q1",
        "median",
        "q3",
        F.least("_low", "q1").alias("whisker_low"),
        F.greatest("_high", "q3").alias("whisker_high"),
        F.coalesce("n_fliers", F.lit(0)).alias("n_fliers"),
    )


def box_fliers(
    df: DataFrame,
    category: str,
    value: str,
    top_n: int,
    key: str,
    positive_only: bool = False,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """The rows beyond the whiskers of `box_stats`."""
    boxes = _boxes(df, category, value, top_n, positive_only, max_rows)
    x = F.col(value)
    return (
        boxes.values.join(F.broadcast(boxes.quartiles), category)
        .where((x < F.col("lower_bound")) | (x > F.col("upper_bound")))
        .select(key, category, value)
    )
