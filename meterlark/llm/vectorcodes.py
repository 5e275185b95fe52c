"""Short codes for vectors: one codebook entry per part, by exact rounds over Hilbert-sorted blocks.

Each component x becomes the integer floor(256 * x), and a vector is cut into PARTS equal
consecutive parts (the last ones are filled up with zeros if its length is no multiple). Every
part position has a codebook of its own, which starts as that part of the vectors with the
smallest ids. A round gives every part to its nearest entry (squared Euclidean distance, ties to
the lower index) and replaces each entry by the floor of the mean of its parts.

Vectors are read once, in chunks of bounded size. In a chunk, each part position's points are
sorted along a Hilbert curve and cut into flat blocks of BLOCK points that follow each other, of
which the smallest and largest component of each dimension (a box) and the sums are stored. In a
round, the distances of an entry to the nearest and the farthest corner of a box tell which
entries can be nearest to any of its points. A block with one such entry adds its stored sums; for
the others, integer kernels compare the points with the entries of their block's shortlist. All
arithmetic is in integers, so results depend on neither the blocks nor the layout.

Chunks are written to the shared folder; a round reads them and sends one small array per task.
Vectors stay in their chunk, so no component is shuffled. Only codebooks (PARTS * entries rows)
pass the driver.

Rows whose vector is null or holds null or non-finite components are dropped. A null id or label
is a value like any other; null ids come after all others. Ids that repeat are ordered by their
vectors and coded each. With fewer vectors than entries, the codebooks are as much smaller. A
vector whose length differs from that of the vector with the smallest id gets null code and
error, and counts for nothing. Components whose integer is beyond 2 ** 26 are an error with that
message. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark.functions.joins import attach
from meterlark.session import materialize

#: Parts of a vector, entries of a codebook, rounds.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Whole numbers per unit.
SCALE = 256
#: Points of a block; vectors of a chunk at most, and components.
BLOCK, CHUNK, CHUNK_COMPONENTS = 32, 32_768, 8 << 20
#: Bits of a position on the Hilbert curve.
CURVE_BITS = 60
#: Largest absolute value of a component's integer, with which squared distances stay exact.
LARGEST = 1 << 26
#: Labels up to this number are joined by a broadcast, more by a shuffle.
BROADCAST_LABELS = 200_000


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component."""
    found = np.floor(vectors.astype(np.float64) * SCALE)
    if found.size and np.abs(found).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // SCALE}")
    return found.astype(np.int64)


def hilbert(points: np.ndarray) -> np.ndarray:
    """Position of each point on a Hilbert curve through the points' box, as an unsigned integer.

    Gray-code steps from the highest bit down turn and mirror the axes as the curve does.
    """
    n, width = points.shape
    width = min(width, CURVE_BITS)
    if not n or not width:
        return np.zeros(n, np.uint64)
    bits = max(1, min(16, CURVE_BITS // width))
    low = points[:, :width].min(0)
    span = np.maximum(points[:, :width].max(0) - low, 1)
    axes = ((points[:, :width] - low) * ((1 << bits) - 1) // span).T.copy()
    step = 1 << (bits - 1)
    while step > 1:
        below = step - 1
        for k in range(width):
            high = (axes[k] & step) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[k]) & below)
            axes[0] ^= np.where(high, below, swap)
            axes[k] ^= swap
        step >>= 1
    for k in range(1, width):
        axes[k] ^= axes[k - 1]
    turn = np.zeros(n, np.int64)
    step = 1 << (bits - 1)
    while step > 1:
        turn ^= np.where((axes[-1] & step) != 0, step - 1, 0)
        step >>= 1
    axes ^= turn
    out = np.zeros(n, np.uint64)
    for b in reversed(range(bits)):
        for k in range(width):
            out = (out << np.uint64(1)) | ((axes[k] >> b) & 1).astype(np.uint64)
    return out


class Blocks:
    """The sorted points of one part position of a chunk, in blocks."""

    def __init__(self, points: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray) -> None:
        self.points, self.order, self.low, self.high, self.sums = points, order, low, high, sums
        self.n, self.width = points.shape
        self.counts = np.minimum(BLOCK, self.n - BLOCK * np.arange(len(low)))

    @classmethod
    def of(cls, points: np.ndarray) -> Blocks:
        order = np.argsort(hilbert(points), kind="stable")
        points = points[order]
        starts = np.arange(0, len(points), BLOCK)
        ends = [f(points, starts, axis=0) for f in (np.minimum.reduceat, np.maximum.reduceat, np.add.reduceat)]
        return cls(points, order.astype(np.int32), *ends)

    def packed(self) -> list[bytes]:
        """The arrays of `unpacked`, of the points as narrow as they allow."""
        most = max(-int(self.points.min(initial=0)), int(self.points.max(initial=0)) + 1)
        kind = "<i2" if most <= 1 << 15 else "<i4"
        return [self.points.astype(kind).tobytes(), self.order.astype("<i4").tobytes(), *(x.astype("<i8").tobytes() for x in (self.low, self.high, self.sums))]

    @classmethod
    def unpacked(cls, points: bytes, order: bytes, low: bytes, high: bytes, sums: bytes, width: int) -> Blocks:
        at = np.frombuffer(order, "<i4")
        kind = "<i2" if len(points) == 2 * width * len(at) else "<i4"
        boxes = -(-len(at) // BLOCK)
        return cls(np.frombuffer(points, kind).reshape(len(at), width), at, *(np.frombuffer(x, "<i8").reshape(boxes, width) for x in (low, high, sums)))

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """(block, entry): whether the entry can be nearest to a point in the block's box, ties included."""
        low, high, at = self.low[:, None], self.high[:, None], entries[None]
        nearest = np.maximum(np.maximum(low - at, at - high), 0)
        farthest = np.maximum(np.abs(at - low), np.abs(high - at))
        return (nearest**2).sum(2) <= (farthest**2).sum(2).min(1, keepdims=True)

    def assign(self, entries: np.ndarray, every: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry, squared distance) of each sorted point, and the only entry of each block or -1.

        Without `every`, the points of blocks with only one entry are left out.
        """
        short = self.shortlists(entries)
        only = np.where(short.sum(1) == 1, short.argmax(1), -1)
        boxes, size = len(self.low), BLOCK * len(self.low)
        reach = max(int(np.abs(self.low).max(initial=0)), int(np.abs(self.high).max(initial=0))) + int(np.abs(entries).max(initial=0))
        kind = np.int32 if reach * reach * max(1, self.width) < 1 << 31 else np.int64
        columns = np.zeros((self.width, size), kind)
        columns[:, : self.n] = self.points.T
        columns = columns.reshape(self.width, boxes, BLOCK)
        best, entry = np.full((boxes, BLOCK), np.iinfo(kind).max, kind), np.zeros((boxes, BLOCK), np.int32)
        for e, at in enumerate(entries.astype(kind)):
            which = np.flatnonzero(short[:, e] if every else short[:, e] & (only < 0))
            if not len(which):
                continue
            far = np.zeros((len(which), BLOCK), kind)
            for k in range(self.width):
                step = columns[k, which] - at[k]
                far += step * step
            held = best[which]
            closer = far < held
            best[which] = np.where(closer, far, held)
            entry[which] = np.where(closer, e, entry[which])
        return entry.ravel()[: self.n], best.ravel()[: self.n].astype(np.int64), only

    def totals(self, entries: np.ndarray) -> np.ndarray:
        """(entry, 1 + dimension): how many points each entry has, and their sums."""
        entry, _, only = self.assign(entries, False)
        out = np.zeros((len(entries), 1 + self.width), np.int64)
        whole = np.flatnonzero(only >= 0)
        np.add.at(out, only[whole], np.column_stack([self.counts[whole], self.sums[whole]]))
        rest = np.repeat(only < 0, BLOCK)[: self.n]
        if rest.any():
            order = np.argsort(entry[rest], kind="stable")
            names, starts = np.unique(entry[rest][order], return_index=True)
            points = self.points[rest][order].astype(np.int64)
            out[names, 0] += np.diff([*starts, len(order)])
            out[names, 1:] += np.add.reduceat(points, starts, axis=0)
        return out


def _split(vectors: np.ndarray) -> np.ndarray:
    """(part, vector, dimension) of integer vectors."""
    n, length = vectors.shape
    width = -(-length // PARTS)
    filled = np.zeros((n, PARTS * width), np.int64)
    filled[:, :length] = vectors
    return filled.reshape(n, PARTS, width).transpose(1, 0, 2)


def _usable(vectors: DataFrame, vector: str) -> DataFrame:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & ~bad)


_PARTS_OF = "points binary, turn binary, low binary, high binary, sums binary"


def blocks(rows: DataFrame, length: int) -> DataFrame:
    """The written chunks of `rows` (k, label, x), vectors of one length: (chunk, part, ids, labels, and a part's arrays).

    A chunk has a row per part and, as part -1, one with its ids and labels.
    """
    size = max(BLOCK, min(CHUNK, CHUNK_COMPONENTS // max(1, length)))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, size - n)
                held.append(part)
                n += part.num_rows
                start += part.num_rows
                if n == size:
                    yield from chunk(pa.Table.from_batches(held).combine_chunks(), number)
                    number, held, n = number + 1, [], 0
        if n:
            yield from chunk(pa.Table.from_batches(held).combine_chunks(), number)

    def chunk(rows: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        flat = rows.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        points = _split(integers(flat.reshape(n, length)))
        ids, labels = (pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column(k).combine_chunks()) for k in (0, 1))
        yield record(number, -1, ids, labels, [None] * 5)
        for k in range(PARTS):
            yield record(number, k, pa.nulls(1, ids.type), pa.nulls(1, labels.type), Blocks.of(points[k]).packed())

    def record(number: int, part: int, ids: pa.Array, labels: pa.Array, arrays: list) -> pa.RecordBatch:
        columns = [pa.array([number]), pa.array([part], pa.int32()), ids, labels, *(pa.array([x], pa.binary()) for x in arrays)]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "part", "ids", "labels", "points", "turn", "low", "high", "sums"])

    schema = f"chunk long, part int, ids array<{types['k']}>, labels array<{types['label']}>, {_PARTS_OF}"
    return materialize(rows.select("k", "label", "x").mapInArrow(run, schema), "blocks")


def _round(chunks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, dimension) after one round over all chunks."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, 1 + width), np.int64)
        for batch in batches:
            for k, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                totals[k] += Blocks.unpacked(*arrays, width).totals(codebooks[k])
        at = np.argwhere(totals)
        columns = [*(at[:, c].astype(np.int32) for c in range(3)), totals[tuple(at.T)]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "entry", "at", "total"])

    read = chunks.where("part >= 0").select("part", "points", "turn", "low", "high", "sums")
    sums = read.mapInArrow(run, "part int, entry int, at int, total long").groupBy("part", "entry", "at").agg(F.sum("total").alias("total"))
    totals = np.zeros((parts, entries, 1 + width), np.int64)
    for r in sums.collect():  # PARTS * entries * (1 + width) numbers at most
        totals[r["part"], r["entry"], r["at"]] = r["total"]
    count = totals[:, :, :1]
    return np.where(count > 0, totals[:, :, 1:] // np.maximum(count, 1), codebooks)


def _codes(chunks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(k, label, code, error) of every vector of the chunks."""
    width = codebooks.shape[2]
    types = {f.name: f.dataType for f in chunks.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = [], []
            for k, *arrays in zip(*(batch.column(c).to_pylist() for c in (1, 4, 5, 6, 7, 8)), strict=True):
                if k < 0:
                    entry.append(None)
                    error.append(None)
                    continue
                block = Blocks.unpacked(*arrays, width)
                found, far, _ = block.assign(codebooks[k], True)
                back = np.empty(block.n, np.int64)
                back[block.order] = np.arange(block.n)
                entry.append(found[back].astype("u1").tobytes())
                error.append(far[back].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(entry, pa.binary()), pa.array(error, pa.binary())], ["chunk", "part", "ids", "labels", "entry", "error"])

    def whole(chunk: pa.Table) -> pa.Table:
        rows = chunk.sort_by("part")
        ids, labels = (rows.column(c).combine_chunks().slice(0, 1).flatten() for c in (2, 3))
        n = len(ids)
        entry = np.stack([np.frombuffer(x, "u1") for x in rows.column("entry").to_pylist()[1:]], 1)
        error = np.sum([np.frombuffer(x, "<i8") for x in rows.column("error").to_pylist()[1:]], 0)
        text = entry.tobytes().hex()
        code = [text[2 * PARTS * k : 2 * PARTS * (k + 1)] for k in range(n)]
        return pa.Table.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(error, pa.int64())], ["k", "label", "code", "error"])

    kinds = {c: types[c].elementType.simpleString() for c in ("ids", "labels")}
    pieces = chunks.mapInArrow(run, f"chunk long, part int, ids array<{kinds['ids']}>, labels array<{kinds['labels']}>, entry binary, error binary")
    return pieces.groupBy("chunk").applyInArrow(whole, f"k {kinds['ids']}, label {kinds['labels']}, code string, error long")


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers with commas between."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def first_codebooks(rows: DataFrame, entries: int = ENTRIES) -> tuple[np.ndarray, int]:
    """The parts of the vectors (k, x) with the smallest ids (part, entry, dimension), and their length."""
    first = rows.orderBy(F.col("k").asc_nulls_last(), F.col("x")).limit(entries).collect()
    length = len(first[0].x)
    same = [r.x for r in first if len(r.x) == length]
    return _split(integers(np.array(same, np.float64).reshape(len(same), length))), length


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(key, label, code, error) of every usable row, and the codebooks (part, entry, dimension); runs jobs."""
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark: SparkSession = vectors.sparkSession
    rows = _usable(vectors.select(F.col(key).alias("k"), F.col(label).alias("label"), F.col(vector).alias("x")), "x")
    if rows.isEmpty():
        empty = spark.createDataFrame([], rows.select("k", "label").schema)
        codes = empty.withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")})
        return codes.withColumnRenamed("k", key), np.zeros((PARTS, 0, 0), np.int64)
    codebooks, length = first_codebooks(rows, entries)
    chunks = blocks(rows.where(F.size("x") == length), length)
    for _ in range(rounds):
        codebooks = _round(chunks, codebooks)
    others = rows.where(F.size("x") != length).select("k", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return _codes(chunks, codebooks).unionByName(others).withColumnRenamed("k", key), codebooks


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256): `label_error` is the sum over the rows of a label, nulls together."""
    codes, codebooks = compress(vectors, key, vector, label)
    coded = materialize(codes.select(F.col(key).alias("k"), "label", "code", "error"), "codes")
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = attach(coded, sums, ["label"], "left", small=sums.count() <= BROADCAST_LABELS)
    return joined.select(F.col("k").alias(key), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
