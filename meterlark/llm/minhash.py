"""MinHash near-duplicates with tensored banding and links confirmed on full sets.

A document's set holds its distinct shingles of `words` lower-case words; a text with fewer words
has one shingle of all of them. Two collections of HALVES half-keys of ROWS minhashes each are
computed, and every pair of a half-key of the first with one of the second is the key of a table:
HALVES ** 2 tables for 2 * HALVES * ROWS minhashes. Two sets of similarity 0.8 miss each other in
all tables with probability 0.00007, more similar ones less often.

Documents with equal sets are one class, known by a 64-bit hash of the set; only classes are
compared. In each table key every class is compared with the key's smallest class, on full sets.
Classes of a key that are still apart are then compared with each other, in blocks, if at least
AGREEING of their minhashes agree (of linked sets, 1 pair in 70,000 has fewer).

Texts that are null or empty or hold only white space have no shingles and are linked with
nothing. Rows whose id is null are linked with nothing and kept; rows that share an id are linked
with each other. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import Forest, components, small_batches, texts_of
from meterlark.session import materialize

#: Intersection as a share of the union, in hundredths, from which sets are linked.
SIMILARITY = 80
#: Half-keys per collection, and minhashes per half-key.
HALVES, ROWS = 10, 2
#: Minhashes that agree in sets worth a full comparison, of 2 * HALVES * ROWS.
AGREEING = 20
#: Partners of one class that a task compares with it, and classes of a block.
SALT_ROWS, BLOCK = 500, 2500
#: Wanted texts up to this number are found by a broadcast of their ids.
BROADCAST_ROWS = 400_000
#: Ids of dropped documents up to this number are broadcast.
BROADCAST_IDS = 1_000_000

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_SHIFTS = [np.uint64(x) for x in (30, 27, 31)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = (x ^ (x >> _SHIFTS[0])) * _MIX[0]
    x = (x ^ (x >> _SHIFTS[1])) * _MIX[1]
    return x ^ (x >> _SHIFTS[2])


#: Fixed random numbers: one per byte value, the base of the word hash, and one per minhash.
_RANDOM = mix(np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE = _RANDOM[:256]
_BASE = int(_RANDOM[300]) | 1
_FACTORS = _RANDOM[400 : 400 + 2 * HALVES * ROWS] | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base modulo 2 ** 64, and their inverses, up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(1 << 16, 2 * n)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            out.append(p)
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text in UTF-8; A-Z count as a-z."""
    data = np.frombuffer(raw.lower(), np.uint8)
    space = np.concatenate([[True], _SPACE[data], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(raw: bytes, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles; one of all words if there are fewer."""
    h = word_hashes(raw)
    if not len(h):
        return h
    n = min(words, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = mix(out * _RANDOM[500]) + h[k : len(h) - n + 1 + k]
    if n < words:
        out += np.uint64(n)
    return np.unique(mix(out))


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set that is not empty: a 64-bit hash of the whole set, its minhashes, its half-keys."""
    lengths = np.array([len(s) for s in sets], np.int64)
    if not len(sets):
        none = np.zeros((0, len(_FACTORS)), np.uint64)
        return np.zeros(0, np.uint64), none, np.zeros((0, 2 * HALVES), np.uint64)
    flat, starts = np.concatenate(sets), np.cumsum(lengths) - lengths
    whole = mix(np.add.reduceat(mix(flat * _RANDOM[501]), starts) + lengths.astype(np.uint64))
    least = np.empty((len(sets), len(_FACTORS)), np.uint64)
    for k, factor in enumerate(_FACTORS):
        least[:, k] = np.minimum.reduceat((flat ^ _RANDOM[600 + k]) * factor, starts)
    mixed = mix(least).reshape(len(sets), 2 * HALVES, ROWS)
    half = mixed[:, :, 0]
    for k in range(1, ROWS):
        half = mix(half * _RANDOM[503]) + mixed[:, :, k]
    return whole, least, half


def table_keys(half: np.ndarray) -> np.ndarray:
    """All HALVES ** 2 table keys of each row of half-keys; a key also tells its table apart."""
    first = mix(half[:, :HALVES] + _RANDOM[700 : 700 + HALVES])
    second = half[:, HALVES:] + _RANDOM[720 : 720 + HALVES]
    return mix(first[:, :, None] * _RANDOM[504] + second[:, None, :]).reshape(len(half), HALVES * HALVES)


def linked(a: int, b: int, both: int) -> bool:
    """Whether sets of a and b members with `both` in common are similar enough."""
    return 100 * both >= SIMILARITY * (a + b - both)


# ---------------------------------------------------------------- DataFrame operators


def _vertices(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """(key, n_shingles, v, halves) of every row; v and halves are null without words."""

    def run(batches):
        for batch in small_batches(batches, 512, 1, 2_000_000):
            sets = [shingles(t.encode("utf-8", "surrogatepass"), words) for t in texts_of(batch.column(1))]
            n = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(n)
            whole, _, half = sketches([sets[k] for k in some])
            v, halves = np.zeros(len(sets), np.int64), np.zeros((len(sets), 2 * HALVES), np.int64)
            v[some], halves[some] = whole.astype(np.int64), half.astype(np.int64)
            empty = n == 0
            ends = np.concatenate([[0], np.cumsum(np.where(empty, 0, 2 * HALVES))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(halves[some].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(v, mask=empty), lists], [key, "n_shingles", "v", "halves"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, v long, halves array<long>")


def _star_pairs(classes: DataFrame) -> DataFrame:
    """(a, b, more) of classes that share a table key with the smallest class of that key, a.

    `more` tells whether a shared key has further classes. A key's rows are streamed in sorted
    order, 16 bytes each, so that a key that a third of all classes share needs no memory.
    """

    def expand(batches):
        for batch in batches:
            if batch.num_rows:
                half = batch.column(1).flatten().to_numpy().astype(np.uint64).reshape(-1, 2 * HALVES)
                keys = table_keys(half).astype(np.int64)
                ids = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                keys = keys.ravel()
                for k in range(0, len(keys), 500_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[k : k + 500_000]), pa.array(ids[k : k + 500_000])], ["key", "v"])

    def stars(batches):
        key = first = second = None  # the open key, its first class, and its second while that is not emitted
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            start = np.concatenate([[True], keys[1:] != keys[:-1]])
            start[0] = key is None or keys[0] != key
            at = np.maximum.accumulate(np.where(start, np.arange(len(keys)), -1))
            lead = np.where(at >= 0, ids[np.maximum(at, 0)], first if first is not None else 0)
            rank = np.arange(len(keys)) - at
            if at[0] < 0:
                open_rows = at < 0
                rank[open_rows] = np.arange(open_rows.sum()) + (1 if second is None else 2)
            a, b, more = lead[rank > 0], ids[rank > 0], rank[rank > 0] > 1
            later = np.concatenate([rank[1:] == 2, [False]])[rank > 0]
            more |= later  # the second class of a key with a third one
            extra = ([first], [second], [True]) if at[0] < 0 and second is not None and rank[0] == 2 else ([], [], [])
            a, b, more = (np.concatenate([np.array(e, x.dtype), x]) for e, x in zip(extra, (a, b, more), strict=True))
            key = keys[-1]
            first = int(lead[-1])
            second = int(ids[-1]) if rank[-1] == 1 else (first if rank[-1] > 1 else None)
            if rank[-1] == 0:
                first, second = int(ids[-1]), None
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(more)], ["a", "b", "more"])

    keys = classes.select("v", "halves").mapInArrow(expand, "key long, v long")
    found = keys.repartition("key").sortWithinPartitions("key", "v").mapInArrow(stars, "a long, b long, more boolean")
    return found.where("a <> b").groupBy("a", "b").agg(F.max("more").alias("more"))


def _with_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, rows: int) -> DataFrame:
    """`wanted` (with v) and one text of each class; `rows` is its number of rows."""
    wanted = wanted.join(classes.select("v", "rep"), "v")
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text"))
    return texts.join(F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted, "rep")


def _confirmed_stars(pairs: DataFrame, n: int, classes: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """The pairs (a, b) that are linked. A class with many partners is copied to several tasks."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
    members = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.col("b").alias("v"))
    centres = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("v"))
    rows = _with_texts(centres.unionByName(members), classes, docs, key, text, 2 * n)

    def compare(batches):
        centre = None
        for batch in small_batches(batches, 512, 3, 2_000_000):
            a, v = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            good = ([], [])
            for k, t in enumerate(texts_of(batch.column(3))):
                found = shingles(t.encode("utf-8", "surrogatepass"), words)
                if not len(found) or int(sketches([found])[0].astype(np.int64)[0]) != v[k]:
                    continue  # another text of a repeated id
                if v[k] == a[k]:
                    centre = (a[k], found)
                elif centre is not None and centre[0] == a[k]:
                    both = len(np.intersect1d(centre[1], found, assume_unique=True))
                    if linked(len(centre[1]), len(found), both):
                        good[0].append(a[k])
                        good[1].append(v[k])
            yield pa.RecordBatch.from_arrays([pa.array(good[0], pa.int64()), pa.array(good[1], pa.int64())], ["a", "b"])

    ordered = rows.select("a", "salt", "v", "text", (F.col("v") != F.col("a")).alias("late")).repartition("a", "salt").sortWithinPartitions("a", "salt", "late")
    return ordered.mapInArrow(compare, "a long, b long")


def _confirmed_rest(pairs: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """Links between classes that share a key, but of which neither is that key's smallest.

    Only where such classes are not connected already. They are compared in blocks, two blocks
    a task; pairs are neither emitted nor sent anywhere before they are confirmed.
    """
    spark = pairs.sparkSession
    component = found.select(F.col("id").alias("b"), "component")
    rest = pairs.where("more").join(component, "b", "left").select("a", F.col("b").alias("v"), F.coalesce("component", "b").alias("c"))
    open_stars = rest.groupBy("a").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n")).where("low <> high")
    rest = rest.join(open_stars.select("a", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "a")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("v"), "blocks").cast("int"))
    rest = rest.select("a", "v", "c", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rest = materialize(rest.select("a", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "v", "c"), "blocks")
    n = rest.count()
    if not n:
        return spark.createDataFrame([], "a long, b long")
    rows = _with_texts(rest, classes, docs, key, text, n)

    def compare(batches):
        held, task = [], None
        for batch in batches:
            heads = list(zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True))
            for head, t in zip(heads, texts_of(batch.column(6)), strict=True):
                if head[:3] != task:
                    yield links_of(held)
                    held, task = [], head[:3]
                held.append((*head, t))
        yield links_of(held)

    def links_of(held):
        sets, block, v, c = [], [], [], []
        for _, _, _, at, vertex, comp, t in held:
            found = shingles(t.encode("utf-8", "surrogatepass"), words)
            if len(found):
                sets.append(found)
                block.append(at)
                v.append(vertex)
                c.append(comp)
        good = ([], [])
        if len(sets) > 1:
            whole, least, half = sketches(sets)
            v, c, block = np.array(v, np.int64), np.array(c, np.int64), np.array(block)
            real = whole.astype(np.int64) == v
            n = np.array([len(s) for s in sets])
            parts, forest = [None] * len(sets), Forest()
            two = held[0][1] != held[0][2]
            for x in range(len(sets) - 1):
                y = np.arange(x + 1, len(sets))
                y = y[(c[y] != c[x]) & real[y] & real[x] & (100 * np.minimum(n[y], n[x]) >= SIMILARITY * np.maximum(n[y], n[x])) & ((block[y] != block[x]) if two else True)]
                y = y[(half[y, :HALVES] == half[x, :HALVES]).any(1)]
                y = y[(half[y, HALVES:] == half[x, HALVES:]).any(1)]
                y = y[(least[y] == least[x]).sum(1) >= AGREEING]
                for k in y.tolist():
                    if forest.find(int(c[x])) == forest.find(int(c[k])):
                        continue
                    for q in (x, k):
                        if parts[q] is None:
                            parts[q] = set(sets[q].tolist())
                    if linked(int(n[x]), int(n[k]), len(parts[x] & parts[k])):
                        forest.union(int(c[x]), int(c[k]))
                        good[0].append(int(v[x]))
                        good[1].append(int(v[k]))
        return pa.RecordBatch.from_arrays([pa.array(good[0], pa.int64()), pa.array(good[1], pa.int64())], ["a", "b"])

    ordered = rows.select("a", "i", "j", "block", "v", "c", "text").repartition("a", "i", "j").sortWithinPartitions("a", "i", "j", "v")
    return ordered.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of `docs`; runs jobs.

    `component_id` is the smallest id that links reach, `kept` tells whether it is the row's own.
    """
    rows = materialize(_vertices(docs, key, text, words), "sketches")
    named = rows.where(F.col("v").isNotNull() & F.col(key).isNotNull())
    classes = materialize(named.groupBy("v").agg(F.min(key).alias("rep"), F.first("halves").alias("halves")), "classes")
    pairs = materialize(_star_pairs(classes), "pairs")
    shared = named.groupBy(key).agg(F.min("v").alias("a"), F.max("v").alias("last")).where("a <> last").select(key, "a")
    links = named.join(shared, key).select("a", F.col("v").alias("b"))
    links = materialize(_confirmed_stars(pairs, pairs.count(), classes, docs, key, text, words).unionByName(links), "links")
    found = components(links, "near")
    more = materialize(_confirmed_rest(pairs, found, classes, docs, key, text, words), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more), "near")
    roots = classes.select("v", "rep").join(found.select(F.col("id").alias("v"), "component"), "v", "left").withColumn("component", F.coalesce("component", "v"))
    least = roots.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = roots.join(least, "component").select("v", "component_id")
    joined = rows.join(known, "v", "left").withColumn("component_id", F.when(F.col(key).isNotNull(), F.coalesce("component_id", key)))
    return joined.select(key, "n_shingles", "component_id", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5) -> DataFrame:
    """The rows of `docs` that are kept, all columns; of rows that repeat an id, one. Runs jobs.

    Documents are not shuffled as long as the ids to be dropped are few enough to be broadcast.
    """
    found = near_duplicates(docs, key, text, words).where(F.col(key).isNotNull())
    per_id = found.groupBy(key).agg(F.count("*").alias("_copies"), F.max("kept").alias("_kept"))
    special = materialize(per_id.where("_copies > 1 or not _kept"), "special-ids")
    few = special.count() <= BROADCAST_IDS

    def ids(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows.select(key)) if few else rows.select(key)

    once = docs.join(ids(special), key, "left_anti").select(docs.columns)
    repeated = special.where("_copies > 1 and _kept")
    if repeated.isEmpty():
        return once
    return once.unionByName(docs.join(ids(repeated), key, "left_semi").dropDuplicates([key]).select(docs.columns))
