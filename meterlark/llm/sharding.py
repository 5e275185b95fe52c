"""Shuffled shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order of their key (null first), rows of one key by a hash of
their values, so the numbers do not depend on how the input is laid out. A Feistel network
permutes the numbers of a square that just holds n; a result of n or more is permuted again until
it is smaller (cycle walking), which makes a permutation of 0 to n - 1. Place p goes to shard
p % shards and slot p // shards: shards differ by at most one row, slots have no gaps, and both
follow from (row number, n, seed) alone, as the row number follows from (shard, slot, n, seed).

The numbers come from a range sort of a few small columns over all tasks, not of the texts. Rows
of one key are dealt to several tasks, rows that are equal in every column too (they are
interchangeable). A null text has no bytes and the checksum of an empty one. Repeated and null
keys are rows like any other. An empty table gives no rows. Other columns of the input are not
read by `assign` and kept by `write`, where the names `shard` and `slot` must be free.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.minhash import mix
from meterlark.session import fresh_path, materialize
from meterlark.sources.load import with_dense_id

#: Rounds of the Feistel network.
ROUNDS = 6
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 to rows - 1 that is computed, not stored."""

    rows: int
    seed: int = 0

    @property
    def side(self) -> int:
        """Numbers of half a block: the square of it is at least `rows`, and hardly more."""
        return max(1, math.isqrt(max(0, self.rows - 1)) + 1)

    def _round(self, half: np.ndarray, k: int) -> np.ndarray:
        key = mix(np.array([(self.seed * ROUNDS + k + 1) % 2**64], np.uint64) * _STEP)
        return mix(half * _STEP + key) % np.uint64(self.side)

    def _forward(self, x: np.ndarray) -> np.ndarray:
        side = np.uint64(self.side)
        left, right = x // side, x % side
        for k in range(ROUNDS):
            left, right = right, (left + self._round(right, k)) % side
        return left * side + right

    def _back(self, x: np.ndarray) -> np.ndarray:
        side = np.uint64(self.side)
        left, right = x // side, x % side
        for k in reversed(range(ROUNDS)):
            left, right = (right + side - self._round(left, k)) % side, left
        return left * side + right

    def _walk(self, numbers: np.ndarray, step) -> np.ndarray:
        out = np.asarray(numbers).astype(np.uint64)
        if len(out) and int(out.max()) >= self.rows:
            raise ValueError(f"a number is not below {self.rows}")
        out = step(out)
        while len(outside := np.flatnonzero(out >= np.uint64(self.rows))):
            out[outside] = step(out[outside])
        return out.astype(np.int64)

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each row number."""
        return self._walk(numbers, self._forward)

    def numbers(self, places: np.ndarray) -> np.ndarray:
        """The row number at each place."""
        return self._walk(places, self._back)

    def number_at(self, shard: int, slot: int, shards: int) -> int:
        """The row number in a slot of a shard."""
        return int(self.numbers(np.array([slot * shards + shard]))[0])


def _placed(numbered: DataFrame, permutation: Permutation, shards: int) -> DataFrame:
    """`numbered` (with `_row`) with `shard` and `slot` in place of the row number."""
    at, names = numbered.columns.index("_row"), [c for c in numbered.columns if c != "_row"]

    def run(batches):
        for batch in batches:
            places = permutation.places(batch.column(at).to_numpy())
            kept = [batch.column(batch.schema.names.index(c)) for c in names]
            found = [pa.array((places % shards).astype(np.int32)), pa.array(places // shards)]
            yield pa.RecordBatch.from_arrays([*kept, *found], [*names, "shard", "slot"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_row")
    return numbered.mapInArrow(run, f"{kinds}, shard int, slot long")


def _numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """`rows` with `_row`, by key and `order`; `_split` deals out rows that are equal in both."""
    split = materialize(rows.withColumn("_split", F.monotonically_increasing_id()), "rows")
    return with_dense_id(split, "_row", [key, order, "_split"], 0).drop("_split", order)


def assign(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; runs jobs. Texts are read once and never shuffled."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    facts = docs.select(
        F.col(key).alias("k"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.col(text), F.length(text)).alias("_order"),
    )
    numbered = _numbered(facts, "k", "_order")
    return _placed(numbered, Permutation(numbered.count(), seed), shards).withColumnRenamed("k", key)


def write(docs: DataFrame, shards: int, seed: int = 0, folder: str | None = None, key: str = "doc_id") -> str:
    """Write all rows and columns as Parquet, by shard and in the order of `slot`; returns the folder. Runs jobs.

    A shard is written by several tasks, each with a range of its slots. Columns of map type are
    not supported, since rows of one key are ordered by a hash of all columns.
    """
    for name in ("shard", "slot", "_row", "_order", "_split"):
        if name in docs.columns:
            raise ValueError(f"the column {name} is in the way")
    folder = folder or fresh_path(docs.sparkSession, "shards")
    numbered = _numbered(docs.withColumn("_order", F.xxhash64(*docs.columns)), key, "_order")
    placed = _placed(numbered, Permutation(numbered.count(), seed), shards)
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
    return folder
