"""Exact quantiles in two reads whose memory does not grow with the data.

Spark's `percentile` keeps every distinct value of a group in one task, in a hash map that
cannot spill. Here the first read makes one mergeable sketch per group, whose bounded rank error
gives each wanted rank a narrow bracket of values. The second read counts the rows below and
between the brackets as a few sums, and the rows inside one per distinct value, which gives each
of those its exact rank. A rank that its bracket misses, or a group whose brackets hold too many
rows for one task, is narrowed further: a value range is cut into equal buckets, the buckets are
counted in parallel, and the bucket that holds the wanted rank becomes the next range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlark.functions.joins import attach
from meterlark.session import materialize

MAX_ROWS_PER_TASK = 1_000_000
MAX_ROWS_IN_RANGE = 100_000
BROADCAST_ROWS = 100_000
BUCKETS = 4096
#: Size of a sketch and the number of evenly spaced quantiles that are read from it.
SKETCH_SIZE = 4096
GRID = 512


def bucket_of(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Equal-width bucket of `value` in [low, high]; never decreases as the value grows."""
    share = (value / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0))
    # A range too narrow to be halved has two values at most.
    share = F.coalesce(share, F.when(value > low, 1.0).otherwise(0.0))
    return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    by: Sequence[str] = (),
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """One row per group: `by`, the number of values `n`, and one column per named probability.

    Linear interpolation between neighbours; NULL values are left out. Runs jobs that read `df` twice,
    and more often where more than `max_rows` rows of a group lie in brackets, so write an expensive
    one first.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    sketched = _sketched(rows, by)
    position = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    wanted = [F.floor(at) for at in position.values()] + [F.ceil(at) for at in position.values()]
    found = _at_ranks(rows, sketched, by, wanted, max_rows)
    per_group = found.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values")
    )
    return attach(sketched.select(*by, "n"), per_group, by).select(
        *by,
        "n",
        *[
            _between(F.col("_values")[F.floor(at)], F.col("_values")[F.ceil(at)], at).alias(name)
            for name, at in position.items()
        ],
    )


def _between(low: Column, high: Column, at: Column) -> Column:
    """Linear interpolation between the values at the ranks around `at`.

    Both sides of a rank that is a whole number are the same value, also an infinite one.
    """
    weighted = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
    return F.when(low == high, low).otherwise(weighted)


def values_at_ranks(
    rows: DataFrame, by: Sequence[str], ranks: Sequence[Column], max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """Values at 0-based ascending ranks: `by`, `_rank`, `_value`, and how many rows of the
    group are smaller (`_below`) and equal (`_same`). Runs jobs.

    `rows` has the group columns and a non-null double `_x`; `ranks` are expressions over the number
    `n` of a group's rows. Infinities and NaN, which sort as the largest value, are counted apart
    and their ranks answered from the counts.
    """
    return _at_ranks(rows, _sketched(rows, by), by, ranks, max_rows)


def _is_finite() -> Column:
    return ~F.isnan("_x") & (F.abs("_x") != float("inf"))


def _sketched(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group its rows, infinities and NaN, least and largest value, and a grid of near quantiles."""
    x, finite = F.col("_x"), _is_finite()
    counted = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(x == float("-inf")).alias("_negative"),
        F.count_if(finite).alias("_finite"),
        F.count_if(x == float("inf")).alias("_positive"),
        F.count_if(F.isnan(x)).alias("_nan"),
        F.min(F.when(finite, x)).alias("_lo"),
        F.max(F.when(finite, x)).alias("_hi"),
        F.kll_sketch_agg_double(F.when(finite, x), F.lit(SKETCH_SIZE)).alias("_sketch"),
    )
    steps = F.expr(f"array({', '.join(f'{i / GRID!r}D' for i in range(GRID + 1))})")
    # A sketch without values cannot be asked.
    grid = F.when(F.col("_finite") > 0, F.kll_sketch_get_quantile_double("_sketch", steps))
    return materialize(counted.withColumn("_grid", grid).drop("_sketch"), "sketched")


def _at_ranks(
    rows: DataFrame, sketched: DataFrame, by: Sequence[str], ranks: Sequence[Column], max_rows: int
) -> DataFrame:
    by = list(by)
    wanted = sketched.where(F.col("n") > 0).withColumn("_rank", F.explode(F.array_distinct(F.array(*ranks))))
    below_finite = F.col("_rank") < F.col("_negative")
    among_finite = ~below_finite & (F.col("_rank") < F.col("_negative") + F.col("_finite"))
    above_finite = F.col("_rank") < F.col("_negative") + F.col("_finite") + F.col("_positive")

    def kind(least: Column, infinite: Column, nan: Column) -> Column:
        return F.when(below_finite, least).when(above_finite, infinite).otherwise(nan)

    special = wanted.where(~among_finite).select(
        *by,
        "_rank",
        kind(F.lit(float("-inf")), F.lit(float("inf")), F.lit(float("nan"))).alias("_value"),
        kind(
            F.lit(0).cast("bigint"),
            F.col("_negative") + F.col("_finite"),
            F.col("_negative") + F.col("_finite") + F.col("_positive"),
        ).alias("_below"),
        kind(F.col("_negative"), F.col("_positive"), F.col("_nan")).alias("_same"),
    )

    # The published error of a rank in a sketch, doubled; a wrong bracket only costs further reads.
    error = 2 * 2.296 / SKETCH_SIZE**0.9021
    at, n = F.col("_rank") - F.col("_negative"), F.col("_finite")
    first, last = F.floor((at / n - error) * GRID).cast("int"), F.ceil(((at + 1) / n + error) * GRID).cast("int")
    expected = F.least((2 * error + 3 / GRID) * n + 2, n) * len(ranks)
    finite_ranks = wanted.where(among_finite).select(
        *by,
        "_rank",
        "_negative",
        "_finite",
        "_lo",
        "_hi",
        F.when(first <= 0, F.col("_lo")).otherwise(F.get("_grid", first)).alias("_from"),
        F.when(last >= GRID, F.col("_hi")).otherwise(F.get("_grid", last)).alias("_to"),
        (expected <= max_rows).alias("_near"),
    )
    known = finite_ranks.agg(F.count_if("_near").alias("near"), F.count_if(~F.col("_near")).alias("far")).first()
    rows = rows.where(_is_finite())
    parts, far = [special], finite_ranks.where(~F.col("_near"))
    if known["near"]:
        near = finite_ranks.where("_near")
        found = materialize(_in_brackets(rows, near, by, len(ranks), known["near"] <= BROADCAST_ROWS), "found")
        parts.append(found)
        if found.count() < known["near"]:
            hits = found.select(*by, "_rank", F.lit(True).alias("_hit"))
            missed = attach(near, hits, [*by, "_rank"], "left").where("_hit is null").drop("_hit")
            far, known = far.unionByName(missed), {"far": 1}
    if known["far"]:
        parts.append(_searched(rows, far, by, len(ranks), max_rows))
    return reduce(DataFrame.unionByName, parts)


def _in_brackets(rows: DataFrame, near: DataFrame, by: list[str], most: int, small: bool) -> DataFrame:
    """The values at ranks whose brackets `_from` to `_to` hold them.

    Rows outside of all brackets are counted together per gap between them, so that a running
    count over the gaps and the values inside gives exact ranks.
    """
    brackets = near.groupBy(*by).agg(F.collect_set(F.struct("_from", "_to")).alias("_brackets"))
    slots = [f"get(_brackets, {i})" for i in range(most)]
    inside = F.expr(" or ".join(f"coalesce(_x between {b}._from and {b}._to, false)" for b in slots))
    # A gap begins where the last bracket below it ends; the first gap begins nowhere.
    ends = ", ".join(f"if({b}._to < _x, {b}._to, null)" for b in slots)
    gap = F.expr(f"greatest(-double('infinity'), {ends})")
    counts = (
        attach(rows, brackets, by, small=small)
        .select(*by, inside.alias("_inside"), F.when(inside, F.col("_x")).otherwise(gap).alias("_value"))
        .groupBy(*by, "_value", "_inside")
        .agg(F.count("*").alias("_same"))
    )
    # Per group few sums, and as many values as brackets hold.
    upto = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_value", F.desc("_inside")).rowsBetween(Window.unboundedPreceding, 0)
    spans = counts.withColumn("_end", F.sum("_same").over(upto)).where("_inside")
    lists = near.groupBy(*by).agg(F.collect_list("_rank").alias("_ranks"), F.first("_negative").alias("_negative"))
    matched = attach(spans, lists, by, small=small)
    end = F.col("_negative") + F.col("_end")
    start = end - F.col("_same")
    hits = F.filter("_ranks", lambda r: (r >= start) & (r < end))
    return matched.where(F.size(hits) > 0).select(
        *by, F.explode(hits).alias("_rank"), "_value", start.alias("_below"), "_same"
    )


def _searched(rows: DataFrame, far: DataFrame, by: list[str], most: int, max_rows: int) -> DataFrame:
    """The values at ranks by narrowing from the whole range of a group.

    Each round reads the rows once and shuffles only bucket counts. After a round a range holds at
    least two filled buckets or is a single value, so every round leaves fewer rows; one that does
    not is an error.
    """
    state = materialize(
        far.select(*by, "_rank", "_lo", "_hi", F.col("_negative").alias("_before"), F.col("_finite").alias("_inside")), "ranks"
    )
    enough = min(max_rows, MAX_ROWS_IN_RANGE)
    is_open = (F.col("_lo") < F.col("_hi")) & (F.col("_inside") > enough)
    left = None
    while True:
        counted = state.agg(
            F.count("*").alias("all"),
            F.count_if(is_open).alias("open"),
            F.sum(F.when(is_open, F.col("_inside"))).alias("rows"),
        ).first()
        small = counted["all"] <= BROADCAST_ROWS
        if not counted["open"]:
            break
        if left is not None and counted["rows"] >= left:
            raise RuntimeError("a round of narrowing has left as many rows as before")
        left = counted["rows"]
        pending = state.where(is_open)
        narrowed = _narrow(rows, pending, by, most, small)
        state = materialize(state.where(~is_open).unionByName(narrowed), "ranks")

    counts = (
        _rows_in_ranges(rows, state, by, most, small)
        .groupBy(*by, "_lo", "_hi", "_before", "_x")
        .agg(F.count("*").alias("_n"))
    )
    # Few rows, or one distinct value, per window partition.
    chosen = _at_rank(state, _with_span(counts, by, "_x"), by, small)
    return chosen.select(
        *by,
        "_rank",
        F.col("_x").alias("_value"),
        F.col("_start").alias("_below"),
        F.col("_n").alias("_same"),
    )


def _rows_in_ranges(
    rows: DataFrame, state: DataFrame, by: list[str], most: int, small: bool
) -> DataFrame:
    """Rows inside a wanted range of their group, with that range.

    A group has at most `most` ranges. Two ranges are equal or have no value in common.
    """
    ranges = state.groupBy(*by).agg(F.collect_set(F.struct("_lo", "_hi", "_before")).alias("_ranges"))
    slots = [F.get("_ranges", F.lit(i)) for i in range(most)]
    hit = F.coalesce(*[F.when(F.col("_x").between(r["_lo"], r["_hi"]), r) for r in slots])
    return (
        attach(rows, ranges, by, small=small)
        .select(*by, "_x", hit.alias("_hit"))
        .where(F.col("_hit").isNotNull())
        .select(*by, "_x", "_hit.*")
    )


def _with_span(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add the first and last 0-based rank that each counted row covers."""
    upto = Window.partitionBy(*by, "_lo", "_hi").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_end", F.col("_before") + F.sum("_n").over(upto)).withColumn(
        "_start", F.col("_end") - F.col("_n")
    )


def _at_rank(state: DataFrame, spans: DataFrame, by: list[str], small: bool) -> DataFrame:
    """The counted rows that cover a wanted rank of their range."""
    wanted = state.select(*by, "_rank", "_lo", "_hi")
    matched = attach(spans.drop("_before"), wanted, [*by, "_lo", "_hi"], small=small)
    return matched.where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_end")))


def _narrow(
    rows: DataFrame, pending: DataFrame, by: list[str], most: int, small: bool
) -> DataFrame:
    """Replace each pending range by the bucket that holds its rank."""
    bucket = bucket_of(F.col("_x"), F.col("_lo"), F.col("_hi"), BUCKETS)
    counts = (
        _rows_in_ranges(rows, pending, by, most, small)
        .groupBy(*by, "_lo", "_hi", "_before", bucket.alias("_bucket"))
        .agg(F.count("*").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    )
    spans = _with_span(counts, by, "_bucket")
    return _at_rank(pending, spans, by, small).select(
        *by,
        "_rank",
        F.col("_min").alias("_lo"),
        F.col("_max").alias("_hi"),
        F.col("_start").alias("_before"),
        F.col("_n").alias("_inside"),
    )
