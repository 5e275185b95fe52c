"""The trie of conversation prefixes, as balanced parentheses per shard.

A node is a distinct sequence of first turns (role, text); its members are the conversations that
start with it. The conversations, sorted by their sequences, are cut into shards. A shard is the
depth-first walk of its part of the trie: "(" where a node begins, ")" where it ends, one bit
each, with the excess of "(" kept as the least of each block and of each GROUP blocks (a range
min-max index). `findclose` finds the end of a node, which delimits its subtree; the number of
"()" pairs in it is the number of leaves, differences of cumulative arrays over the walk give its
members and its savings. Nodes on the path of a shard's first or last conversation (its spines)
may go on in the next shard: they are added up by a small aggregate, and all others are final.

Turns are known by two 64-bit hashes together with their position, and a node by the XOR of those
of its turns, so a node's identity needs no order. Texts are hashed where they are read and never
shuffled. A conversation is cut into segments of SEGMENT turns, each sorted below the node where it
begins, so no row holds a whole long conversation; the totals of deeper segments are carried to
the nodes above by a sum along the conversation that is the least member.

Turns are ordered by number (null first), then by their hashes; a null role or text is empty.
Rows whose id is null belong to no conversation and are left out. Repeated rows are turns of their
own. Conversations of any length and copies in any number are handled; only the digest of the ids
that end in one node is made by one task, as a stream. Other columns are not read. An empty table
has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlark.session import materialize
from meterlark.sources.load import with_dense_id

#: Turns of a segment, and turns and conversations of a shard.
SEGMENT, SHARD = 64, 100_000
#: Bits of a block of the excess index, and blocks of a group.
BITS, GROUP = 256, 64
#: Spine nodes up to this number are joined by a broadcast, more by a shuffle.
BROADCAST_NODES = 1_000_000


# ---------------------------------------------------------------- balanced parentheses


class Parentheses:
    """A sequence of parentheses (1 opens, 0 closes) with a two-level index of the least excess."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1)
        self.least = _least(self.excess, BITS)
        self.lowest = _least(self.least, GROUP)

    def findclose(self, place: int) -> int:
        """Where the node that opens at `place` closes: the next place whose excess is one less than there."""
        if not self.bits[place + 1]:
            return place + 1
        target = int(self.excess[place]) - 1
        block = place // BITS
        end = (block + 1) * BITS
        if (found := _first(self.excess[place + 1 : end], target)) is not None:
            return place + 1 + found
        group = (block + 1) // GROUP
        stop = (group + 1) * GROUP
        found = _first(self.least[block + 1 : stop], target)
        if found is None:
            group += 1 + _first(self.lowest[group + 1 :], target)
            block = group * GROUP + _first(self.least[group * GROUP : (group + 1) * GROUP], target)
        else:
            block += 1 + found
        return block * BITS + _first(self.excess[block * BITS : (block + 1) * BITS], target)

    def leaves_before(self) -> np.ndarray:
        """rank of "()": how many such pairs begin before each place."""
        pair = np.zeros(len(self.bits) + 1, np.int64)
        pair[1:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        return np.cumsum(pair)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    return np.minimum.reduceat(values, np.arange(0, len(values), size)) if len(values) else values


def _first(values: np.ndarray, target: int) -> int | None:
    """The first place that is not above the target."""
    hit = values <= target
    at = int(hit.argmax()) if len(hit) else 0
    return at if len(hit) and hit[at] else None


# ---------------------------------------------------------------- conversations


def _turn_hashes(role: str, text: str) -> list[Column]:
    parts = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    return [F.xxhash64(*parts).alias("r1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("r2")]


def numbered_turns(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(k, i, r1, r2, chars): each turn's place in its conversation (from 1), hashes and length; a written table.

    Places come from a range sort of all turns, so a conversation that holds many of them is
    numbered by many tasks.
    """
    turns = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("k"), F.col(turn).alias("t"), *_turn_hashes(role, text), F.coalesce(F.length(text), F.lit(0)).alias("chars")
    )
    turns = turns.withColumn("split", F.monotonically_increasing_id())
    numbered = with_dense_id(materialize(turns, "turns"), "n", ["k", "t", "r1", "r2", "split"])
    numbered = materialize(numbered.select("k", "n", "r1", "r2", "chars"), "turns")
    first = numbered.groupBy("k").agg(F.min("n").alias("first"))
    return numbered.join(first, "k").select("k", (F.col("n") - F.col("first") + 1).alias("i"), "r1", "r2", "chars")


def rebuilt(turns: DataFrame, group: int = 100, spread: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their first turns with the first of their group; both results are written.

    Conversation k takes the first h turns of conversation k - k % group (% as in SQL; all if it has fewer,
    none if it is absent) and its own after the first h; h = crc32(decimal k) % spread. Returns the
    turns (k, i, r1, r2, chars) and every conversation (k, n), also without turns.
    """
    turns = materialize(turns, "turns")
    sizes = turns.groupBy("k").agg(F.count("*").alias("own"))
    h = F.crc32(F.col("k").cast("string").cast("binary")) % spread
    sizes = sizes.select("k", "own", (F.col("k") - F.col("k") % group).alias("base"), h.alias("h"))
    of_base = sizes.where("k % {0} = 0".format(group)).select(F.col("k").alias("base"), F.col("own").alias("there"))
    sizes = sizes.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    sizes = materialize(sizes.select("k", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")), "sizes")
    heads = turns.where(f"k % {group} = 0 and i < {spread}").withColumnRenamed("k", "base")
    first = sizes.where("taken > 0").join(heads, "base").where("i <= taken").select("k", "i", "r1", "r2", "chars")
    rest = turns.join(sizes.select("k", "h", "taken"), "k").where("i > h").select("k", (F.col("i") - F.col("h") + F.col("taken")).alias("i"), "r1", "r2", "chars")
    return materialize(first.unionByName(rest), "rebuilt"), sizes.select("k", "n")


def segments(turns: DataFrame, sizes: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(band, a1, a2, path, chars, k, e1, e2, last, n) of all conversations; a written table.

    `path` holds two hashes per turn, a and e name the nodes where the segment begins and ends. A
    conversation whose length is a multiple of `segment` has an empty last segment, so that all
    members of a node that ends a segment begin one there.
    """
    named = turns.select("k", "i", F.xxhash64("i", "r1").alias("g1"), F.xxhash64("i", "r2", F.lit(2)).alias("g2"), "chars")
    named = named.withColumn("band", F.floor((F.col("i") - 1) / segment).cast("long"))
    found = named.groupBy("k", "band").agg(
        F.sort_array(F.collect_list(F.struct("i", "g1", "g2", "chars"))).alias("turns"), F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2")
    )
    every = sizes.select("k", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / segment))).alias("band"))
    found = every.join(found, ["k", "band"], "left")
    # One row per segment; the running XOR is streamed.
    so_far = Window.partitionBy("k").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    ends = {f"e{c}": F.coalesce(F.bit_xor(f"x{c}").over(so_far), F.lit(0)).cast("long") for c in (1, 2)}
    starts = {f"a{c}": F.col(f"e{c}").bitwiseXOR(F.coalesce(f"x{c}", F.lit(0))).cast("long") for c in (1, 2)}
    path = F.flatten(F.transform("turns", lambda t: F.array(t["g1"], t["g2"])))
    return materialize(
        found.withColumns(ends).withColumns(starts).select(
            "band", "a1", "a2",
            F.coalesce(path, F.array().cast("array<long>")).alias("path"),
            F.coalesce(F.col("turns.chars"), F.array().cast("array<int>")).alias("chars"),
            "k", "e1", "e2",
            (F.col("band") == F.floor(F.col("n") / segment)).alias("last"),
            "n",
        ),
        "segments",
    )


# ---------------------------------------------------------------- shards

_ARRAYS = ("opened", "row", "band", "depth", "g1", "g2", "chars", "parent", "below", "spine", "members")
_SHARD = "shard long, bits binary, nodes long, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def encode(rows: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """The shards of `segments` with (children, leaves, saved) of the nodes where they end; a written table.

    A shard holds its parentheses as packed bits, its nodes in the order of the walk (where they
    open, and what they are), and the ids of its members in the order of the walk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        builder = _Builder(segment)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                builder.add(*row)
                if builder.size >= shard:
                    yield builder.shard(number)
                    number, builder = number + 1, _Builder(segment)
        if builder.size:
            yield builder.shard(number)

    order = ["band", "a1", "a2", "path", "k"]
    ordered = rows.select(*order, "chars", "children", "leaves", "saved").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(run, _SHARD), "shards")


class _Builder:
    """Walks rows in their sorted order and collects one shard."""

    def __init__(self, segment: int) -> None:
        self.segment, self.size = segment, 0
        self.bits: list[int] = []
        self.nodes: list[tuple] = []
        self.below: list[tuple[int, int, int]] = []
        self.members: list[int] = []
        self.path: list[int] = []  # the nodes that are open, the one where the segment begins first
        self.first: list[int] = []
        self.start: tuple | None = None
        self.steps: list[int] = []

    def add(self, band: int, a1: int, a2: int, steps: list[int], k: int, chars: list[int], children: int, leaves: int, saved: int) -> None:
        same = 0
        if self.start == (band, a1, a2):
            while 2 * same < min(len(self.steps), len(steps)) and self.steps[2 * same : 2 * same + 2] == steps[2 * same : 2 * same + 2]:
                same += 1
            same += 1
        self.bits += [0] * (len(self.path) - same)
        del self.path[same:]
        for d in range(same, len(chars) + 1):
            g1, g2, n = (steps[2 * d - 2], steps[2 * d - 1], chars[d - 1]) if d else (a1, a2, 0)
            self.nodes.append((len(self.bits), len(self.members), band, d, g1, g2, n, self.path[-1] if self.path else -1))
            self.below.append((children, leaves, saved) if d == self.segment else (-1, 0, 0))
            self.path.append(len(self.nodes) - 1)
            self.bits.append(1)
        self.members.append(k)
        self.start, self.steps = (band, a1, a2), steps
        if len(self.members) == 1:
            self.first = list(self.path)
        self.size += 1 + len(chars)

    def shard(self, number: int) -> pa.RecordBatch:
        spine = np.zeros(len(self.nodes), "u1")
        spine[self.first + self.path] = 1
        bits = np.array([*self.bits, *[0] * len(self.path)], "u1")
        arrays = [*(np.array(c, "<i8") for c in zip(*self.nodes, strict=True)), np.array(self.below, "<i8"), spine, np.array(self.members, "<i8")]
        columns = [pa.array([number]), pa.array([np.packbits(bits).tobytes()]), pa.array([len(self.nodes)]), *(pa.array([a.tobytes()]) for a in arrays)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "bits", "nodes", *_ARRAYS])


_NODE = (
    "band long, depth long, p1 long, p2 long, up1 long, up2 long, chars long, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved long, d_children long, d_leaves long, d_saved long, parent_conv_id long, up_open boolean, open boolean, above array<struct<p1:long,p2:long>>"
)


def _read_shard(bits: bytes, count: int, arrays: list[bytes]) -> pa.RecordBatch:
    """The nodes of one shard, from its parentheses and arrays."""
    opened, row, band, depth, g1, g2, chars, parent, below, spine, members = (np.frombuffer(a, "u1" if c == "spine" else "<i8") for c, a in zip(_ARRAYS, arrays, strict=True))
    below, spine = below.reshape(-1, 3), spine > 0
    tree = Parentheses(np.unpackbits(np.frombuffer(bits, "u1"), count=2 * count))
    close = np.array([tree.findclose(p) for p in opened.tolist()], np.int64)
    at = np.arange(count)
    end = at + (close - opened + 1) // 2  # of the subtree, in the order of the walk
    until = np.where(end < count, row[np.minimum(end, count - 1)], len(members))
    convs = until - row
    least = np.minimum.reduceat(np.append(members, members[-1]), np.column_stack([row, until]).ravel())[::2]

    def subtree(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[at]

    deeper, up = below[:, 0] >= 0, np.maximum(parent, 0)
    n_children = np.bincount(parent[~spine & (parent >= 0)], minlength=count)
    # Every "()" in a subtree is a leaf, but where deeper segments follow it stands for their leaves,
    # and on a spine it is left to the merge.
    rank = tree.leaves_before()
    pair = close == opened + 1
    leaves = rank[close] - rank[opened] + subtree(np.where(spine, -1 * pair, np.where(deeper, below[:, 1] - 1, 0)))
    saved = subtree(np.where(spine, 0, (convs - 1) * chars + below[:, 2]))
    p1, p2 = g1.copy(), g2.copy()
    for d in range(1, int(depth.max()) + 1):
        some = np.flatnonzero(depth == d)
        p1[some] ^= p1[parent[some]]
        p2[some] ^= p2[parent[some]]
    above: list[list | None] = [None] * count
    for v in np.flatnonzero(spine).tolist():
        q = int(parent[v])
        above[v] = [{"p1": int(p1[v]), "p2": int(p2[v])}, *(above[q] if q >= 0 else [])]
    final_children = np.where(~spine & deeper, below[:, 0], n_children)
    numbers = [band, depth, p1, p2, p1[up], p2[up], chars, least, convs, final_children, leaves, saved, *below.T]
    up_open = (parent >= 0) & spine[up]
    columns = [
        *(pa.array(np.ascontiguousarray(c, np.int64)) for c in numbers),
        pa.array(least[up], mask=up_open | (parent < 0)),
        pa.array(up_open),
        pa.array(spine),
        pa.array(above, pa.list_(pa.struct([("p1", pa.int64()), ("p2", pa.int64())]))),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _NODE.split(", ")])


def decode(shards: DataFrame) -> DataFrame:
    """All nodes of the shards, those on spines merged; (band, depth, p1, p2, chars, conv_id, n_convs, n_children, n_leaves, saved, parent_conv_id).

    Writes them as they are in the shards first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, bits, count, *arrays in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield _read_shard(bits, count, arrays)

    found = materialize(shards.mapInArrow(run, _NODE), "nodes")
    name = ["band", "p1", "p2"]
    parts = found.where("open").groupBy(*name).agg(
        *(F.first(c).alias(c) for c in ("depth", "up1", "up2", "chars", "above")),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
        *(F.max(c).alias(c) for c in ("d_children", "d_leaves", "d_saved")),
    )
    parts = materialize(parts, "spines")
    kids = parts.where("depth > 0").groupBy("band", F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(F.count("*").alias("kids"))
    parts = parts.join(kids, name, "left")
    deeper = F.col("d_children") >= 0
    children = F.when(deeper, F.col("d_children")).otherwise(F.col("n_children") + F.coalesce("kids", F.lit(0)))
    parts = materialize(parts.withColumn("n_children", children).drop("kids"), "spines")
    leaf = F.when(deeper, F.col("d_leaves")).otherwise((F.col("n_children") == 0).cast("long"))
    gain = parts.select("band", F.explode("above").alias("to"), leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars") + F.col("d_saved")).alias("gain"))
    gain = gain.groupBy("band", "to.p1", "to.p2").agg(F.sum("leaf").alias("leaf"), F.sum("gain").alias("gain"))
    whole = parts.join(gain, name).withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("gain")})
    columns = ["band", "depth", "p1", "p2", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved"]
    ids = parts.select("band", F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    ids = F.broadcast(ids) if parts.count() <= BROADCAST_NODES else ids
    closed = found.where("not open")
    tops = [F.when(F.col("depth") > 0, F.col(c)).alias(c) for c in ("up1", "up2")]
    below_open = closed.where("up_open").select(*columns, "up1", "up2").unionByName(whole.select(*columns, *tops))
    below_open = below_open.join(ids, ["band", "up1", "up2"], "left").select(*columns, "parent_conv_id")
    return closed.where("not up_open").select(*columns, "parent_conv_id").unionByName(below_open)


# ---------------------------------------------------------------- whole conversations


def _totals_below(rows: DataFrame, segment: int, shard: int) -> DataFrame:
    """(band, e1, e2, children, leaves, saved): everything below each node where a segment of `band` ends; a written table.

    Each segment start's own totals stand with its least member, and are added up along that
    conversation from its end and then over the members of a node: deeper starts below a node are
    each counted once, since their least members are members of the node.
    """
    none = {c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}
    starts = decode(encode(rows.withColumns(none), segment, shard)).where("depth = 0 and band > 0")
    starts = starts.select("band", F.col("p1").alias("a1"), F.col("p2").alias("a2"), F.col("conv_id").alias("k"), "n_leaves", "saved", "n_children")
    starts = materialize(starts, "starts")
    held = rows.where("band > 0").select("band", "a1", "a2", "k").join(starts, ["band", "a1", "a2", "k"], "left")
    from_end = Window.partitionBy("k").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, 0)
    sums = held.select("band", "a1", "a2", *(F.coalesce(F.sum(c).over(from_end), F.lit(0)).alias(c) for c in ("n_leaves", "saved")))
    sums = sums.groupBy("band", "a1", "a2").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    both = sums.join(starts.select("band", "a1", "a2", F.col("n_children").alias("children")), ["band", "a1", "a2"])
    return materialize(both.select((F.col("band") - 1).alias("band"), F.col("a1").alias("e1"), F.col("a2").alias("e2"), "children", "leaves", "saved"), "below")


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of each node in which conversations (depth, p1, p2, k) end, their ids ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            names = np.column_stack([c.to_numpy() for c in batch.columns[:3]])
            ids = batch.column(3).to_pylist()
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), len(ids)]
            out = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = ",".join(map(str, ids[a:b])).encode()
                if tuple(names[a].tolist()) == node:
                    sha.update(b"," + part)
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = tuple(names[a].tolist()), hashlib.sha256(part)
            if out:
                yield listed(out)
        if node:
            yield listed([(*node, sha.hexdigest())])

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["depth", "p1", "p2", "ends_sha256"])

    name = ["depth", "p1", "p2"]
    ordered = ends.select(*name, "k").repartition(*name).sortWithinPartitions(*name, "k")
    return ordered.mapInArrow(run, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(turns: DataFrame, sizes: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of conversations, given as turns (k, i, r1, r2, chars) and conversations (k, n); runs jobs.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    the least member, the parent's one, members, children, leaves of the subtree, the sum over the
    subtree of (members - 1) times the length of the node's text, and the digest of the ids of the
    members that end in the node.
    """
    rows = segments(turns, sizes, segment)
    if rows.where("band > 0").isEmpty():
        below = rows.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
    else:
        below = rows.join(_totals_below(rows, segment, shard), ["band", "e1", "e2"], "left")
        below = below.fillna(0, ["children", "leaves", "saved"])
    nodes = decode(encode(below, segment, shard)).where("depth > 0 or band = 0")
    nodes = nodes.withColumn("depth", F.col("band") * segment + F.col("depth"))
    ends = rows.where("last").select(F.col("n").alias("depth"), F.col("e1").alias("p1"), F.col("e2").alias("p2"), "k")
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(_digests(ends), ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def prefixes(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """The nodes of `trie` for conversations as they are; runs jobs."""
    turns = numbered_turns(conversations, key, turn, role, text)
    sizes = materialize(turns.groupBy("k").agg(F.count("*").alias("n")), "sizes")
    return trie(turns, sizes, segment, shard)


def rebuilt_prefixes(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """The nodes of `trie` for conversations that share first turns as `rebuilt` makes them; runs jobs."""
    return trie(*rebuilt(numbered_turns(conversations, key, turn, role, text)), segment, shard)
