"""Joins that keep NULL keys together, for small per-group tables, and joins on keys that very many rows share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.session import materialize

#: Rows from which a key counts as frequent, and rows of its other side that are broadcast.
FREQUENT_ROWS = 1_000_000
BROADCAST_ROWS = 100_000


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Add the columns of `table` to `rows`, matching `keys` with NULL equal to NULL.

    Set `small` only for a table whose row count is known to be bounded; it is then broadcast.
    Without keys, `table` has one row and is added as a scalar subquery.
    """
    if not keys:
        packed = table.select(F.struct(*table.columns)).scalar()
        return rows.withColumn("_packed", packed).select(*rows.columns, "_packed.*")
    renamed = table.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[c for c in table.columns if c not in keys],
    )
    if small:
        renamed = F.broadcast(renamed)
    match = None
    for k in keys:
        same = rows[k].eqNullSafe(renamed[f"_key_{k}"])
        match = same if match is None else match & same
    joined = rows.join(renamed, match, how)
    return joined.drop(*[f"_key_{k}" for k in keys])


def join_frequent(
    rows: DataFrame,
    parents: DataFrame,
    keys: Sequence[str],
    frequent: int = FREQUENT_ROWS,
    most_parents: int = BROADCAST_ROWS,
) -> DataFrame:
    """The inner join of `rows` and `parents` on equal `keys`, where few keys may hold most of `rows`.

    Rows per key are counted first, with sums that each task begins for its own rows. Keys with more
    than `frequent` rows are joined where their rows are, by a broadcast of their parents, and all other
    keys by a plain join, so that no task receives all rows of a frequent key, also without adaptive execution. If the
    parents of frequent keys are more than `most_parents` rows, only the most frequent keys whose parents
    fit are taken out. Runs jobs; reads `rows` three times, the first time the keys only. A NULL key
    joins nothing. Columns are the keys, then those of `rows`, then those of `parents`.
    """
    keys = list(keys)
    counts = rows.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > frequent)
    counts = materialize(counts, "frequent")
    if counts.isEmpty():
        return rows.join(parents, keys)
    # Keys without parents stay in, so that their rows are dropped without a shuffle.
    of_parents = parents.select(*keys).join(counts, keys).groupBy(*keys).agg(F.count("*").alias("_parents"))
    counts = materialize(counts.join(of_parents, keys, "left").fillna(0, ["_parents"]), "frequent")
    while True:
        # Frequent keys are at most all rows / `frequent`, whatever the data.
        taken = counts.where(F.col("_rows") > frequent)
        size = taken.agg(F.count("*").alias("keys"), F.sum("_parents").alias("parents")).first()
        if not size["keys"]:
            return rows.join(parents, keys)
        if size["keys"] + size["parents"] <= most_parents:
            break
        frequent *= 2
    taken = F.broadcast(taken.select(*keys))
    near = F.broadcast(materialize(parents.join(taken, keys, "left_semi"), "parents"))
    rest = rows.join(taken, keys, "left_anti").join(parents.join(taken, keys, "left_anti"), keys)
    return rest.unionByName(rows.join(near, keys))
