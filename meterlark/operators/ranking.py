"""Ranks inside groups, and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlark.functions.joins import attach
from meterlark.session import materialize

MAX_ROWS_PER_TASK = 2_000_000
MAX_CUTS = 8191
BROADCAST_CUTS = 1_000_000
TOP_CANDIDATES = 1000


def rank_within(
    df: DataFrame,
    group: str,
    value: str,
    name: str,
    max_rows: int = MAX_ROWS_PER_TASK,
    largest: int | None = None,
) -> DataFrame:
    """Add the descending rank of a non-null `value` inside `group`, with gaps after ties.

    A window holds a whole group in one task, so it is used as is only when the largest
    group was counted and fits. Otherwise the large groups are cut at values taken from a
    sketch of their distribution. The rank is then the rank inside the value range plus the
    number of rows in the ranges above, whatever the cuts are; they only decide balance. Runs
    jobs; pass the row count of the `largest` group where it is known, to save counting.
    """
    if largest is None:
        largest = df.groupBy(group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= max_rows:
        descending = Window.partitionBy(group).orderBy(F.col(value).desc())
        return df.withColumn(name, F.rank().over(descending).cast("bigint"))

    rows = materialize(df, "rank-rows")
    most = min(MAX_CUTS, -(-largest // max_rows) * 2)
    cuts = materialize(_cuts(rows, group, value, largest, max_rows, most), "rank-cuts")
    n_cuts = cuts.agg(F.sum(F.size("_cuts"))).first()[0] or 0
    small = n_cuts <= BROADCAST_CUTS

    below = _count_below(F.col("_cuts"), F.col(value), most)
    placed = attach(rows, cuts, [group], "left", small).withColumn(
        "_below", F.coalesce(below, F.lit(0))
    )
    # A value equal to a cut gets a range of its own: all its rows tie.
    on_cut = F.coalesce(F.get("_cuts", F.col("_below")) == F.col(value), F.lit(False))
    placed = placed.withColumn("_range", F.col("_below") * 2 + on_cut.cast("int")).drop("_cuts", "_below")

    above = Window.partitionBy(group).orderBy(F.col("_range").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = placed.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    widest = None
    if most == MAX_CUTS:
        # So large a group may leave ranges that are too large; they are cut again.
        ranges = materialize(ranges, "rank-ranges")
        widest = ranges.where(F.col("_range") % 2 == 0).agg(F.max("_n")).first()[0]
    offsets = ranges.select(
        group,
        "_range",
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"),
        F.greatest(F.ceil(F.col("_n") / max_rows), F.lit(1)).alias("_parts"),
    )
    offsets = materialize(offsets.where((F.col("_above") > 0) | (F.col("_parts") > 1)), "rank-offsets")
    small = small and offsets.count() <= BROADCAST_CUTS
    placed = attach(placed, offsets, [group, "_range"], "left", small)
    if widest and widest > max_rows:
        within, outer, inner = f"_{name}_within", f"_{name}_above", f"_{name}_inner"
        nested = placed.select(
            *df.columns,
            F.struct(group, "_range").alias(within),
            F.coalesce(F.col("_above"), F.lit(0)).alias(outer),
        )
        nested = rank_within(nested, within, value, inner, max_rows, widest)
        return nested.select(*df.columns, (F.col(outer) + F.col(inner)).cast("bigint").alias(name))
    # Tied rows may be spread over several tasks: each of them has rank one in its part.
    part = F.when(
        F.col("_range") % 2 == 1,
        F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col("_parts"), F.lit(1))),
    ).otherwise(F.lit(0))
    placed = placed.withColumn("_part", part)
    inside = Window.partitionBy(group, "_range", "_part").orderBy(F.col(value).desc())
    rank = F.coalesce(F.col("_above"), F.lit(0)) + F.rank().over(inside)
    return placed.select(*df.columns, rank.cast("bigint").alias(name))


def _cuts(
    rows: DataFrame, group: str, value: str, largest: int, max_rows: int, most: int
) -> DataFrame:
    """Sorted cut values, at most `most`, for each group that is too large for one task."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") > max_rows)
    sizes = materialize(sizes, "rank-sizes")
    small = sizes.count() <= BROADCAST_CUTS
    shares = [i / (most + 1) for i in range(1, most + 1)]
    points = F.approx_percentile(value, F.array(*[F.lit(s) for s in shares]), F.lit(10_000))
    sketched = (
        attach(rows.select(group, value), sizes, [group], small=small)
        .groupBy(group)
        .agg(points.alias("_points"), F.max("_n").alias("_n"))
    )
    # Fewer cuts for smaller groups: about one for each half task of rows.
    stride = F.greatest(F.floor(F.lit(largest) / F.col("_n")), F.lit(1))
    kept = F.filter("_points", lambda _, i: i % stride == 0)
    return sketched.select(group, F.array_sort(F.array_distinct(kept)).alias("_cuts"))


def _count_below(cuts, value, most: int):
    """How many of the sorted `cuts` are smaller than `value`, by halving steps."""
    steps = [1 << bit for bit in reversed(range(most.bit_length()))]

    def advance(found, step):
        reached = found + step
        ahead = (reached <= F.size(cuts)) & (F.get(cuts, reached - 1) < value)
        return F.when(ahead, reached).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def top_k(df: DataFrame, value: str, k: int, key: list[str], nulls: str = "first") -> DataFrame:
    """The `k` rows with the largest value; `key` decides ties.

    With `nulls="first"` missing values rank above all others, as in SQL's default for DESC.
    """
    column = F.col(value)
    order = column.desc_nulls_first() if nulls == "first" else column.desc_nulls_last()
    return df.orderBy(order, *[F.col(k_).asc_nulls_last() for k_ in key]).limit(k)


def top_k_matched(
    facts: DataFrame,
    parents: DataFrame,
    key: str,
    value: str,
    k: int,
    ties: list[str],
    nulls: str = "first",
    candidates: int = TOP_CANDIDATES,
) -> DataFrame:
    """`top_k` of the join of `facts` with `parents` on `key`.

    The best `candidates` facts are joined first; both tables are read without a shuffle. When
    at least `k` of them find a parent they hold the answer, because every other fact ranks
    below them. Otherwise the whole join is ranked.
    """
    best = top_k(facts, value, max(candidates, k), ties, nulls)
    # Broadcast: at most max(candidates, k) rows.
    matched = materialize(parents.join(F.broadcast(best), key), "top")
    if matched.limit(k).count() < k:
        matched = parents.join(facts, key)
    return top_k(matched, value, k, ties, nulls)


def top_categories(df: DataFrame, category: str, k: int) -> DataFrame:
    """The `k` most frequent categories with their row counts; the name decides ties."""
    return category_counts(df, category).limit(k)


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """Frequency of each non-null category, most frequent first."""
    counts = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.col("n_rows").desc(), F.col(category).asc())


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """Frequency of each non-null value, in value order."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n_rows"))
    return counts.orderBy(F.col(value).asc())
