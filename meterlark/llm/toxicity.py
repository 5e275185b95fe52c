"""Toxicity by two Kneser-Ney models of word pairs, one of toxic and one of ordinary labelled texts.

The models count all pairs of neighbouring words of the labelled texts, words being told apart by
64-bit hashes; the first word follows a mark for the start. With n_c(u, v) the number of texts of
class c that hold the pair, n_c(u) its sum over v, k_c(v) the number of different words that v was
seen after in class c (the Kneser-Ney count), k(v) that in both classes together, and K_c and K
their sums,

    P_c(v | u) = max(n_c(u, v) - PAIR_DISCOUNT, 0) / n_c(u) + B_c(u) * P_c(v)
    P_c(v) = max(k_c(v) - DISCOUNT, 0) / K_c + B_c * P(v)
    P(v) = max(k(v) - SHARED_DISCOUNT, 0) / K + B / (1 + number of words)

where B_c(u), B_c and B are the shares that the discounts took away (1 after a word that the class
never held). So an expression that is rare in a class is smoothed by the counts that both classes
share. Pairs count once per text, since texts repeat themselves. A word's difference is
ln P_toxic(v | u) - ln P_ordinary(v | u). For a pair that no class holds in more than PAIR_DISCOUNT
texts it is the sum of ln B_toxic(u) - ln B_ordinary(u) and ln P_toxic(v) - ln P_ordinary(v), where
the first is 0 for a word u without a frequent pair, and the second ln B_toxic - ln B_ordinary for
a word v that neither class has seen after more than DISCOUNT words. The table of differences holds
all other pairs, words u and words v. `fit` without `pairs` leaves out the first of the three levels.

A text's difference is averaged over its words, and over stretches of STRETCH words (a shorter text
is divided by a whole stretch). The score is a logistic function of the mean and of the largest
stretch, since ordinary words around an expression do not excuse it. The discounts and STRETCH were
chosen once by cross-validation among four of five folds of labelled texts, none of them the fold
that queries hold out.

Counts cover all labelled training texts up to MOST_LABELLED documents (beyond that a sample by the
hash of the id). Each task hands on each pair once. The table is written sorted, in parts, by
tasks, given to executors as files and memory-mapped by the workers; its size follows the labelled
texts, not the scored ones. Documents are scored in one pass without a shuffle. The logistic
function is fitted on training texts that the counts leave out, from a histogram.

A null text counts as empty; an empty text gets the score of a zero difference. A text of any
length is scored whole. Rows that repeat are scored each. Without labels of both classes there are
no models: every score is the share of toxic labels (0 without labels), and `Model.known` is
false. Extra columns are passed through by `score` and never read; a column of the name of the
result is an error.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import small_batches, store, texts_of
from meterlark.llm.minhash import _RANDOM, mix, word_hashes
from meterlark.session import materialize, shared_folder

#: Bytes of texts that a task counts, and scores, at once.
CHUNK, BATCH = 16_000_000, 4_000_000
#: Labels up to this number are broadcast, more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
#: Labelled documents on which a model is fitted, on average at most.
MOST_LABELLED = 1_000_000
#: Range and steps of the histogram on which the logistic function is fitted: of the largest stretch, and of the mean.
REACH, STEPS = 8.0, (1024, 512)
#: Words over which the difference of the log-likelihoods is averaged.
STRETCH = 2
#: What a count loses to the shared counts, and a shared count to words not seen.
DISCOUNT, SHARED_DISCOUNT = 2.0, 0.75
#: What the number of a class's texts with a pair loses to the class's words.
PAIR_DISCOUNT = 8
#: Files of the table.
PARTS = 16
#: Stands before the first word of a text.
START = _RANDOM[700]
#: Tells the key of a word that others follow from that of the word itself.
FOLLOWED = int(_RANDOM[702])


@dataclass
class Model:
    """Files of differences by word, the difference of all other words, and the logistic function."""

    files: list[tuple[int, str]] | None
    other: float
    slopes: tuple[float, float]
    shift: float
    pairs: bool = False

    @property
    def known(self) -> bool:
        """Whether there were labels of both classes."""
        return self.files is not None


_MARKS = str.maketrans(dict.fromkeys(".,;:!?\"()[]", " "))


def labelled(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, label int) of the rows with a label; of contradicting labels the largest counts."""
    per_id = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_label"))
    few = labels.count() <= BROADCAST_LABELS
    return docs.select(key, text).join(F.broadcast(per_id) if few else per_id, key).select(key, text, F.col("_label").alias("label"))


def fold(key: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def fit(train: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_LABELLED, pairs: bool = False) -> Model:
    """Fit on the rows of `train` (key, text, label); runs jobs. With `pairs`, words are judged after the word before them.

    The rows whose fold is 1 only fit the logistic function, the others only the counts.
    """
    sizes = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    if sum(sizes.values()) > most:
        share = int(most / sum(sizes.values()) * (1 << 30))
        train = train.where(F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30)) < share)
    rows = train.select(text, "label", fold(key).alias("_fold"))
    counted = rows.where(F.coalesce("_fold", F.lit(0)) != 1)
    totals = {r.label: r["count"] for r in counted.groupBy("label").count().collect()}
    toxic, ordinary = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not ordinary:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        return Model(None, 0.0, (0.0, 0.0), _logit(share), pairs)
    model = _table(_pair_counts(counted, text), pairs)
    held = _scored(rows.where("_fold = 1").select(text, "label"), text, model)

    def cell(name: str, steps: int) -> F.Column:
        held_in = F.least(F.greatest(F.col(name), F.lit(-REACH)), F.lit(REACH))
        return F.floor((held_in + REACH) * (steps / (2 * REACH))).cast("int")

    cells = held.groupBy(cell("_peak", STEPS[0]).alias("a"), cell("_mean", STEPS[1]).alias("b"), "label").count().collect()
    middle = [((r.a + 0.5) / STEPS[0] * 2 * REACH - REACH, (r.b + 0.5) / STEPS[1] * 2 * REACH - REACH) for r in cells]
    model.slopes, model.shift = _logistic(middle, [r.label for r in cells], [r["count"] for r in cells], toxic / (toxic + ordinary))
    return model


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def hashes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the word before each word and of the words of all texts, lower-case and without punctuation that follows, and the words of each text."""
    found = [word_hashes(t.lower().translate(_MARKS).encode("utf-8", "surrogatepass")) for t in texts]
    after = np.concatenate([np.zeros(0, np.uint64), *found])
    lengths = np.array([len(h) for h in found], np.int64)
    before = np.empty_like(after)
    before[1:] = after[:-1]
    ends = np.cumsum(lengths)
    before[(ends - lengths)[lengths > 0]] = START
    return before, after, lengths


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Key of each pair in the table of differences."""
    return mix(mix(before * _RANDOM[701]) + after)


def peak(differences: np.ndarray) -> float:
    """The largest mean difference over a stretch of a text."""
    if len(differences) <= STRETCH:
        return float(differences.sum(dtype=np.float64)) / STRETCH
    sums = np.cumsum(differences, dtype=np.float64)
    return float(max(sums[STRETCH - 1], (sums[STRETCH:] - sums[:-STRETCH]).max())) / STRETCH


def _pair_counts(rows: DataFrame, text: str) -> DataFrame:
    """(u, v, t, o): how many toxic and how many ordinary texts hold each pair of neighbouring words; a written table."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1 << 20, 0, CHUNK):
            before, after, lengths = hashes_of(texts_of(batch.column(0)))
            if not len(after):
                continue
            toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
            keys, first, at = np.unique(pair_keys(before, after), return_index=True, return_inverse=True)
            at, of = np.divmod(np.unique(at * len(lengths) + np.repeat(np.arange(len(lengths)), lengths)), len(lengths))
            counts = [np.bincount(at[side[of]], minlength=len(keys)).astype(np.int32) for side in (toxic, ~toxic)]
            columns = [before[first].view(np.int64), after[first].view(np.int64), *counts]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["u", "v", "t", "o"])

    held = rows.select(text, "label").mapInArrow(pairs, "u long, v long, t int, o int")
    return materialize(held.groupBy("u", "v").agg(F.sum("t").alias("t"), F.sum("o").alias("o")), "pairs")


def _word_counts(pairs: DataFrame) -> DataFrame:
    """(v, t, o, n): how many different words each word was seen after in toxic, in ordinary and in all texts; a written table."""
    kinds = [F.count_if(F.col(c) > 0).alias(c) for c in "to"]
    return materialize(pairs.groupBy("v").agg(*kinds, F.count("*").alias("n")), "words")


def _pair_differences(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(key, difference) of all frequent pairs, and of the words u they start with; `words` has (v, pt, po), the words' probabilities."""
    frequent = (F.col("t") > PAIR_DISCOUNT) | (F.col("o") > PAIR_DISCOUNT)
    sums = [F.sum(c).cast("double").alias(f"n{c}") for c in "to"]
    kept = [F.try_divide(F.sum(F.least(F.col(c), F.lit(PAIR_DISCOUNT))), F.sum(c)).alias(f"b{c}") for c in "to"]
    starts = pairs.groupBy("u").agg(*sums, *(F.coalesce(b, F.lit(1.0)).alias(f"b{c}") for b, c in zip(kept, "to", strict=True)), F.max(frequent).alias("any"))
    starts = materialize(starts.where("any"), "pair-starts")
    own = {c: F.coalesce(F.try_divide(F.greatest(F.col(c) - PAIR_DISCOUNT, F.lit(0)), f"n{c}"), F.lit(0.0)) for c in "to"}
    logs = {c: F.log(own[c] + F.col(f"b{c}") * F.col(f"p{c}")) for c in "to"}
    found = pairs.where(frequent).join(starts, "u").join(words, "v").select("u", "v", (logs["t"] - logs["o"]).cast("float").alias("difference"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pair_keys(*(batch.column(k).to_numpy().view(np.uint64) for k in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(2)], ["v", "difference"])

    after = starts.select(F.col("u").bitwiseXOR(F.lit(_signed(FOLLOWED))).alias("v"), F.log(F.col("bt") / F.col("bo")).cast("float").alias("difference"))
    return found.mapInArrow(keyed, "v long, difference float").unionByName(after)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _table(counted: DataFrame, pairs: bool) -> Model:
    """The differences of all words, and pairs if asked for, as files that executors fetch; no logistic function yet."""
    spark, words = counted.sparkSession, _word_counts(counted)
    taken = {"t": DISCOUNT, "o": DISCOUNT, "n": SHARED_DISCOUNT}
    sums = words.agg(
        F.count("*").alias("words"), *(F.sum(c).cast("double").alias(c) for c in taken), *(F.sum(F.least(F.col(c), F.lit(d))).alias(f"d{c}") for c, d in taken.items())
    ).first()
    shared = F.greatest(F.col("n") - SHARED_DISCOUNT, F.lit(0.0)) / sums.n + sums.dn / sums.n / (1 + sums.words)
    likely = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / max(sums[c], 1.0) + _left(sums, c) * shared for c in "to"}
    known = words.where((F.col("t") > DISCOUNT) | (F.col("o") > DISCOUNT))
    known = known.select("v", (F.log(likely["t"]) - F.log(likely["o"])).cast("float").alias("difference"))
    if pairs:
        known = known.unionByName(_pair_differences(counted, words.select("v", *(likely[c].alias(f"p{c}") for c in "to"))))
    folder = f"{shared_folder(spark)}/meterlark-shipped"
    fs, path = store(folder)
    fs.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if found:
            keys, values = (np.concatenate([b.column(k).to_numpy() for b in found]) for k in (0, 1))
            name = f"words-{uuid.uuid4().hex}"
            to, place = store(f"{folder}/{name}")
            with to.open_output_stream(place, compression=None) as out:
                out.write(keys.astype("<i8").tobytes() + values.astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([int(keys[0])]), pa.array([name])], ["first", "name"])

    ordered = known.repartitionByRange(PARTS, "v").sortWithinPartitions("v")
    files = sorted((r["first"], r["name"]) for r in materialize(ordered.mapInArrow(write, "first long, name string"), "word-files").collect())
    for _, name in files:
        spark.sparkContext.addFile(f"{folder}/{name}")
    return Model(files, math.log(_left(sums, "t") / _left(sums, "o")), (0.0, 0.0), 0.0, pairs)


def _left(sums, c: str) -> float:
    """The share of a class that the discount leaves to the shared counts; all of it without words."""
    return sums[f"d{c}"] / sums[c] if sums[c] else 1.0


class Differences:
    """The table of a model, memory-mapped."""

    def __init__(self, files: list[tuple[int, str]], other: float) -> None:
        self.other, self.first = other, np.array([first for first, _ in files], np.int64)
        self.parts = []
        for _, name in files:
            raw = np.memmap(SparkFiles.get(name), "u1", "r")
            n = len(raw) // 12
            self.parts.append((raw[: 8 * n].view("<i8"), raw[8 * n :].view("<f4")))

    def _found(self, distinct: np.ndarray, other: float) -> np.ndarray:
        """The difference of each key, in ascending order, and `other` for those the table does not hold."""
        found = np.full(len(distinct), other, np.float32)
        edges = [*np.searchsorted(distinct, self.first).tolist(), len(distinct)]
        for (keys, values), a, b in zip(self.parts, edges[:-1], edges[1:], strict=True):
            place = np.minimum(np.searchsorted(keys, distinct[a:b]), len(keys) - 1)
            found[a:b] = np.where(keys[place] == distinct[a:b], values[place], np.float32(other))
        return found

    def of(self, words: np.ndarray) -> np.ndarray:
        """The difference of each word, given by its hash."""
        distinct, at = np.unique(words.view(np.int64), return_inverse=True)
        return self._found(distinct, self.other)[at]

    def after(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """The difference of each word after the word before it."""
        starts, at = np.unique((before ^ np.uint64(FOLLOWED)).view(np.int64), return_inverse=True)
        pairs, which = np.unique(pair_keys(before, words).view(np.int64), return_inverse=True)
        found = self._found(pairs, math.nan)[which]
        return np.where(np.isnan(found), self._found(starts, 0.0)[at] + self.of(words), found)


_DIFFERENCES: dict[tuple, Differences] = {}


def differences(files: list[tuple[int, str]], other: float) -> Differences:
    """The worker's table; one at a time."""
    name = (tuple(files), other)
    if name not in _DIFFERENCES:
        _DIFFERENCES.clear()
        _DIFFERENCES[name] = Differences(files, other)
    return _DIFFERENCES[name]


def _logistic(middles: list[tuple[float, float]], labels: list[int], counts: list[int], share: float) -> tuple[tuple[float, float], float]:
    """Slopes and shift of a logistic function through counted points, slightly held back; by Newton's method."""
    if len(set(labels)) < 2:
        return (20.0, 0.0), _logit(share)
    x = np.column_stack([np.array(middles), np.ones(len(middles))])
    y, n = np.array(labels, float), np.array(counts, float)
    w, hold = np.array([1.0, 0.0, _logit(share)]), 1e-3
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        v = n * np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * v[:, None]).T @ x + hold * np.eye(3), x.T @ (n * (y - p)) - hold * w)
        w = w + step * min(1.0, 20 / max(abs(step).max(), 1e-12))
        if abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])), float(w[2])


def _evaluated(rows: DataFrame, text: str, model: Model, names: list[str], values_of) -> DataFrame:
    """`rows` with further columns: what `values_of` makes of each text's largest stretch and mean."""
    at, kept = rows.columns.index(text), rows.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    files, other, pairs = model.files, model.other, model.pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = differences(files, other)
        for batch in small_batches(batches, 4096, at, BATCH):
            before, words, lengths = hashes_of(texts_of(batch.column(at)))
            found = table.after(before, words) if pairs else table.of(words)
            parts = np.split(found, np.cumsum(lengths)[:-1])
            peaks = np.array([peak(w) for w in parts], np.float64)
            means = np.array([float(w.sum(dtype=np.float64)) / max(STRETCH, len(w)) for w in parts], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v) for v in values_of(peaks, means))], [*kept, *names])

    return rows.mapInArrow(run, ", ".join([kinds, *(f"`{n}` double" for n in names)]))


def _scored(rows: DataFrame, text: str, model: Model) -> DataFrame:
    """`rows` with `_peak`, the largest mean difference over a stretch, and `_mean`, that of all words."""
    return _evaluated(rows, text, model, ["_peak", "_mean"], lambda peaks, means: (peaks, means))


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """All rows and columns of `docs`, with the probability of a toxic text in column `to`."""
    if to in docs.columns:
        raise ValueError(f"the column {to} is in the way")
    if not model.known:
        return docs.withColumn(to, F.lit(1 / (1 + math.exp(-model.shift))))
    (a, b), c = model.slopes, model.shift

    def probability(peaks: np.ndarray, means: np.ndarray) -> tuple[np.ndarray]:
        return (1 / (1 + np.exp(-np.clip(a * peaks + b * means + c, -500, 500))),)

    return _evaluated(docs, text, model, [to], probability)
