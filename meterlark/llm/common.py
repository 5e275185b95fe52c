"""Helpers that several operators share: tables, files in the shared folder, components."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark.session import materialize, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of an input folder, read by Spark wherever that folder is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path inside it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def ship_bytes(spark: SparkSession, data: bytes, label: str) -> str:
    """Give every executor a local copy of a file; returns the name for `SparkFiles.get`.

    The file is written to the shared folder first. Spark copies it to each executor that
    runs a task of the job, also to one that starts later.
    """
    # Not a path of `scratch`: executors that start later fetch the file too.
    name = f"{label}-{uuid.uuid4().hex}"
    uri = f"{shared_folder(spark)}/meterlark-shipped/{name}"
    fs, path = store(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data)
    spark.sparkContext.addFile(uri)
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a column; a null counts as an empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int, column: int, size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of some rows and about `size` bytes of one text column."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = 0
        while start < n:
            stop = start + int(np.searchsorted(np.cumsum(lengths[start : start + rows]), size, side="right"))
            stop = min(max(stop, start + 1), n)
            yield batch.slice(start, stop - start)
            start = stop


class Forest:
    """Disjoint sets of the integers of one task; a root is the smallest member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if y < x:
            x, y = y, x
        self.parent[y] = x
        return True


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of `edges` (a long, b long): one row (id, component) per id.

    `component` is the smallest id that links reach. Alternating large-star and small-star
    steps, each written to the shared folder, so no link or component passes the driver.
    Every step takes a minimum per id before it joins, so an id with very many links is
    pre-aggregated by each task; the join back on it is left to adaptive skew handling.
    Rows with a null end and links of an id to itself are ignored. Empty in, empty out.
    """
    spark = edges.sparkSession
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct(),
        label,
    )
    empty = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    if edges.isEmpty():
        return empty
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, label)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        small = materialize(small.where("a <> b").distinct(), label)
        if _stars(spark, small):
            return small.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
                small.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        edges = small


def _stars(spark: SparkSession, edges: DataFrame) -> bool:
    """Whether every id has one link down and no centre has a link down itself."""
    per = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    return per.isEmpty() and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
