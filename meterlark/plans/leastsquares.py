"""Least squares over one-hot categories and numbers, with one answer: the smallest coefficients.

Full one-hot columns and an intercept leave coefficients undetermined; of all solutions this is
the one whose coefficients (without the intercept) have the least sum of squares, over columns and
targets with their means taken off. It is the same for any layout of the rows and either solver.

Rows with equal features are points with a weight, so the work follows the combinations. Up to
DENSE columns, each task adds up its points' part of the matrix of products, Spark adds up the
parts, and an eigenvalue factorisation that leaves out the null space solves them. Wider sets are
solved by conjugate gradients from zero, which stay out of the null space too: each step is one
pass in which the tasks multiply their points. WIDEST bounds the columns, whose names and
coefficients the driver holds.

A null category is one of its own; categories not seen in fitting add nothing. Null numbers count as zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark.session import materialize

#: Columns up to which the matrix of products is formed, and columns at most.
DENSE, WIDEST = 2_000, 1_000_000
#: Share of the largest eigenvalue below which a direction is in the null space.
NULL_SHARE = 1e-11
#: Share of the first residual at which conjugate gradients stop, and steps at most.
SMALL_RESIDUAL, STEPS = 1e-11, 2_000
#: Coefficients of one column up to this number are broadcast.
BROADCAST_CATEGORIES = 200_000


@dataclass
class LeastSquares:
    """Coefficients per target: of each category (column, text), of each number, and the intercepts."""

    categorical: list[str]
    numeric: list[str]
    names: list[tuple[int, str]]
    coefficients: np.ndarray  # (categories and numbers, target)
    intercepts: np.ndarray

    def with_predictions(self, rows: DataFrame, to: Sequence[str]) -> DataFrame:
        """`rows` with one prediction per target."""
        spark = rows.sparkSession
        out, keep = rows, rows.columns
        terms = [[F.lit(float(b))] for b in self.intercepts]
        for k, c in enumerate(self.categorical):
            at = [n for n, (column, _) in enumerate(self.names) if column == k]
            table = spark.createDataFrame([(self.names[n][1], *map(float, self.coefficients[n])) for n in at], _schema(k, len(to)))
            out = out.withColumn(f"_k{k}", marked(c)).join(F.broadcast(table) if len(at) <= BROADCAST_CATEGORIES else table, f"_k{k}", "left")
            for t in range(len(to)):
                terms[t].append(F.coalesce(f"_b{k}_{t}", F.lit(0.0)))
        for k, c in enumerate(self.numeric):
            for t in range(len(to)):
                terms[t].append(_number(c) * float(self.coefficients[len(self.names) + k, t]))
        sums = []
        for t, name in enumerate(to):
            total = terms[t][0]
            for term in terms[t][1:]:
                total = total + term
            sums.append(total.alias(name))
        return out.select(*keep, *sums)


def _schema(k: int, targets: int) -> str:
    return ", ".join([f"_k{k} string", *(f"_b{k}_{t} double" for t in range(targets))])


def marked(category: str) -> Column:
    """The category as text, with null as a text that no category has."""
    return F.when(F.col(category).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(category).cast("string")))


def _number(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0))


def points(rows: DataFrame, targets: Sequence[Column], categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """(cats, nums, w, t): the rows with equal features, their number and the sums of their targets; a written table."""
    cats, nums = [marked(c) for c in categorical], [_number(c) for c in numeric]
    named = [F.array(*cats).cast("array<string>").alias("cats"), F.array(*nums).cast("array<double>").alias("nums")]
    values = [t.cast("double").alias(f"_t{k}") for k, t in enumerate(targets)]
    each = rows.select(*named, *values).groupBy("cats", "nums")
    sums = each.agg(F.count("*").cast("double").alias("w"), F.array(*(F.sum(f"_t{k}") for k in range(len(targets)))).alias("t"))
    return materialize(sums, "combinations")


class _Rows:
    """The points of one batch as sparse rows: a category column each, then the numbers."""

    def __init__(self, batch: pa.RecordBatch, index: dict[tuple[int, str], int], columns: int) -> None:
        n = batch.num_rows
        texts = batch.column(0).flatten().to_pylist()
        self.k = len(texts) // n
        self.at = np.array([index[j % self.k, t] for j, t in enumerate(texts)], np.int64).reshape(n, self.k)
        self.nums = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if len(batch.column(1).flatten()) else np.zeros((n, 0))
        self.w = batch.column(2).to_numpy()
        self.t = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.first = columns - self.nums.shape[1]
        self.columns = columns

    def product(self, v: np.ndarray) -> np.ndarray:
        return v[self.at].sum(1) + self.nums @ v[self.first :]

    def back(self, x: np.ndarray) -> np.ndarray:
        out = np.bincount(self.at.ravel(), np.repeat(x, self.k), self.columns).astype(np.float64)
        out[self.first :] += x @ self.nums
        return out

    def gram(self, out: np.ndarray) -> None:
        for a in range(self.k):
            for b in range(self.k):
                np.add.at(out, (self.at[:, a], self.at[:, b]), self.w)
            for c in range(self.nums.shape[1]):
                both = np.bincount(self.at[:, a], self.w * self.nums[:, c], self.columns)
                out[:, self.first + c] += both
                out[self.first + c, :] += both
        out[self.first :, self.first :] += (self.nums * self.w[:, None]).T @ self.nums


def _summed(rows: DataFrame, index: dict, columns: int, shape: tuple[int, ...], add) -> np.ndarray:
    """The sum over all points of what `add` adds to an array per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                add(_Rows(batch, index, columns), out)
        flat = out.ravel()
        at = np.flatnonzero(flat)
        for k in range(0, len(at), 100_000):
            some = at[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], ["at", "x"])

    sums = rows.mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x"))
    out = np.zeros(int(np.prod(shape)))
    found = sums.toPandas()
    out[found["at"].to_numpy(np.int64)] = found["x"].to_numpy()
    return out.reshape(shape)


def fit(rows: DataFrame, targets: Sequence[Column], categorical: Sequence[str], numeric: Sequence[str] = (), dense: int = DENSE) -> LeastSquares:
    """Fit all targets on the rows; runs jobs. Rows without a target must be gone."""
    categorical, numeric = list(categorical), list(numeric)
    each = points(rows, targets, categorical, numeric)
    named = each.select(F.posexplode("cats").alias("column", "text")).distinct()
    width = named.count()
    if width > WIDEST:
        raise ValueError(f"{width} categories are more than {WIDEST}")
    names = sorted((r["column"], r["text"]) for r in named.collect())
    index = {name: k for k, name in enumerate(names)}
    columns, many = len(names) + len(numeric), len(targets)

    def firsts(x: _Rows, out: np.ndarray) -> None:
        out[0, : x.columns] += x.back(x.w)
        out[0, x.columns] += x.w.sum()
        for t in range(many):
            out[1 + t, : x.columns] += x.back(x.t[:, t])
            out[1 + t, x.columns] += x.t[:, t].sum()

    sums = _summed(each, index, columns, (1 + many, columns + 1), firsts)
    n = max(sums[0, -1], 1.0)
    mean, mean_t = sums[0, :-1] / n, sums[1:, -1] / n
    right = (sums[1:, :-1] - n * mean * mean_t[:, None]).T
    if columns <= dense:
        gram = _summed(each, index, columns, (columns, columns), lambda x, out: x.gram(out))
        found = _smallest(gram - n * np.outer(mean, mean), right)
    else:
        found = np.column_stack([_conjugate(lambda v: _times(each, index, columns, v) - n * mean * (mean @ v), right[:, t]) for t in range(many)])
    return LeastSquares(categorical, numeric, names, found, mean_t - mean @ found)


def _times(each: DataFrame, index: dict, columns: int, v: np.ndarray) -> np.ndarray:
    """The matrix of products times a vector, in one pass."""

    def add(x: _Rows, out: np.ndarray) -> None:
        out += x.back(x.w * x.product(v))

    return _summed(each, index, columns, (columns,), add)


def _smallest(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least solution of gram @ x = right, without the null space."""
    if not len(gram):
        return right
    values, vectors = np.linalg.eigh(gram)
    kept = values > values.max(initial=0.0) * NULL_SHARE
    return vectors[:, kept] @ ((vectors[:, kept].T @ right) / values[kept, None])


def _conjugate(times, right: np.ndarray) -> np.ndarray:
    """The same by conjugate gradients from zero."""
    x, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), rest @ rest
    enough = size * SMALL_RESIDUAL**2
    for _ in range(min(STEPS, 2 * len(right))):
        if size <= enough or size == 0:
            break
        ahead = times(way)
        step = size / (way @ ahead)
        x, rest = x + step * way, rest - step * ahead
        size, before = rest @ rest, size
        way = rest + size / before * way
    return x
