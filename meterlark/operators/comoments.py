"""Sums of squares and products of many column pairs in one pass, without a row per pair.

Each task keeps one small block of numbers for all pairs and hands on one row per pair, so the
shuffle carries tasks times pairs rows, whatever the number of data rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that are centred together inside a task.
CHUNK = 16_384
FIELDS = ("n", "mean_a", "mean_b", "square_a", "square_b", "product", "low_a", "high_a", "low_b", "high_b", "odd")


def _block(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """FIELDS (rows) of each pair of columns (columns) over the rows where both are present.

    Absent values are masked NaN of the frame, so `x` is a masked array. Values are shifted by
    their column's mean first; `odd` counts present values that are not finite.
    """
    there = ~np.ma.getmaskarray(x)
    values = np.asarray(x.data, float)
    finite = np.isfinite(values)
    use = there & finite
    shift = np.where(use, values, 0).sum(0) / np.maximum(use.sum(0), 1)
    d = np.where(use, values - shift, 0.0)
    mask = use.astype(float)
    counts, sums, squares, products = mask.T @ mask, d.T @ mask, (d * d).T @ mask, d.T @ d
    present = there.astype(float)
    odd = present.T @ present - counts
    n = counts[left, right]
    some = np.maximum(n, 1)
    sum_a, sum_b = sums[left, right], sums[right, left]
    out = np.zeros((len(FIELDS), len(left)))
    out[0], out[10] = n, odd[left, right]
    out[1], out[2] = shift[left] + sum_a / some, shift[right] + sum_b / some
    out[3] = squares[left, right] - sum_a * sum_a / some
    out[4] = squares[right, left] - sum_b * sum_b / some
    out[5] = products[left, right] - sum_a * sum_b / some
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        both = use[:, a] & use[:, b]
        for column, low in ((a, 6), (b, 8)):
            out[low, k] = np.min(values[:, column], where=both, initial=np.inf)
            out[low + 1, k] = np.max(values[:, column], where=both, initial=-np.inf)
    return out


def _merged(p: np.ndarray | None, q: np.ndarray) -> np.ndarray:
    """The block of the rows of both."""
    if p is None:
        return q
    n = p[0] + q[0]
    some = np.maximum(n, 1)
    gap_a, gap_b, weight = q[1] - p[1], q[2] - p[2], p[0] * q[0] / some
    out = p + q
    out[1] = np.where(p[0] == 0, q[1], np.where(q[0] == 0, p[1], p[1] + gap_a * q[0] / some))
    out[2] = np.where(p[0] == 0, q[2], np.where(q[0] == 0, p[2], p[2] + gap_b * q[0] / some))
    out[3] += gap_a * gap_a * weight
    out[4] += gap_b * gap_b * weight
    out[5] += gap_a * gap_b * weight
    for low in (6, 8):
        out[low], out[low + 1] = np.minimum(p[low], q[low]), np.maximum(p[low + 1], q[low + 1])
    return out


def pair_moments(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per pair and task: `pair` (its index) and FIELDS, in double precision.

    `df` may hold any columns; only those of the pairs are read. Pairs without a common row have n = 0.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    left = np.array([names.index(a) for a, _ in pairs], np.int64)
    right = np.array([names.index(b) for _, b in pairs], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        with np.errstate(all="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in part.columns])
                    absent = np.column_stack([c.is_null().to_numpy(zero_copy_only=False) for c in part.columns])
                    block = _merged(block, _block(np.ma.array(values, mask=absent), left, right))
        if block is not None:
            columns = [pa.array(np.arange(len(left), dtype=np.int32)), *map(pa.array, block)]
            yield pa.RecordBatch.from_arrays(columns, ["pair", *FIELDS])

    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    return doubles.mapInArrow(run, "pair int, " + ", ".join(f"{f} double" for f in FIELDS))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, correlation): Pearson's over the rows where both sides are present.

    NULL where a side is constant there or no row is left, NaN where a present value is not finite.
    Sides whose least and largest value agree are constant, whatever rounding left of their squares.
    """
    # tasks x pairs rows; the window and the aggregate share one exchange.
    whole = Window.partitionBy("pair")

    def mean(side: str) -> Column:
        return F.try_divide(F.sum(F.col("n") * F.col(f"mean_{side}")).over(whole), F.sum("n").over(whole))

    parts = pair_moments(df, pairs).where("n > 0 or odd > 0")
    apart = parts.withColumns({"_a": F.col("mean_a") - mean("a"), "_b": F.col("mean_b") - mean("b")})
    summed = apart.groupBy("pair").agg(
        F.sum(F.expr("product + n * _a * _b")).alias("product"),
        F.sum(F.expr("square_a + n * _a * _a")).alias("square_a"),
        F.sum(F.expr("square_b + n * _b * _b")).alias("square_b"),
        F.sum("odd").alias("odd"),
        *[F.min(f"low_{s}").alias(f"low_{s}") for s in "ab"],
        *[F.max(f"high_{s}").alias(f"high_{s}") for s in "ab"],
    )
    varied = (F.col("low_a") < F.col("high_a")) & (F.col("low_b") < F.col("high_b"))
    strength = F.try_divide(F.col("product"), F.sqrt("square_a") * F.sqrt("square_b"))
    return summed.select("pair", F.when(F.col("odd") > 0, F.lit(float("nan"))).when(varied, strength).alias("correlation"))
