"""Quality by co-training: one classifier sees the text, another only the page's metadata.

Each view turns a row into a few numbered features. A view's classifier is a naive Bayes model:
counts of each feature per label, added up by Spark over all rows. In every round each view
labels the unlabelled rows of which it is sure, and the other view adds those rows, at half
weight, to its own counts. At the end the margins of both views are calibrated together by a
logistic function, and all rows are scored.

Sureness is judged on calibrated probabilities. Counts cover all labelled rows but those whose
fold is 1, which calibrate; all unlabelled rows take part in every round. What reaches the
driver are counts per feature and cells of histograms, whose numbers are fixed.

A null text counts as empty, null metadata as a value of its own; whole texts are read. Rows that
repeat count and are scored each. Without labels of both classes every score is the share of good
labels (1 without labels) and `Model.known` is false; a caller that rejects by score should then not. Extra columns are passed through by
`score`; names that start with `_q_` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import small_batches, texts_of
from meterlark.llm.toxicity import BROADCAST_LABELS, fold
from meterlark.session import materialize

#: Rounds in which the views exchange rows, and how sure a view must be to hand one on.
ROUNDS, SURE = 3, 0.97
#: Weight of a row that the other view has labelled.
BORROWED = 0.5
BINS = 16
#: Cells per side of the histogram of both margins, and its reach.
CELLS, REACH = 128, 24.0
MARKS = b"#$%&*|@~^<>{}[]\\/_+="
CONTENT = ["length", "marks", "exclamation", "digits", "capitals", "spaces", "stops", "word_length", "distinct_words", "distinct_lines", "beyond_ascii", "long_words", "repeats"]
#: Metadata is hashed into this many values.
HASHED = 64
META_SIZE = 16 + 2 * HASHED

_KIND = np.zeros(256, np.uint8)
_KIND[list(MARKS)] = 1
_KIND[list(b"!?")] = 2
_KIND[list(b"0123456789")] = 3
_KIND[65:91] = 4
_KIND[97:123] = 5
_KIND[list(b" \t\n\r\x0b\x0c")] = 6
_KIND[list(b".,;:")] = 7
_KIND[128:] = 8


def content_features(text: str) -> list[int]:
    """One number per feature of a whole text; feature k has the numbers from k * BINS on."""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=9) if raw else np.zeros(9, int)
    words, lines = raw.split(), raw.split(b"\n")
    w = max(1, len(words))
    shares = [
        kinds[1] / n,
        kinds[2] / n,
        kinds[3] / n,
        kinds[4] / max(1, kinds[4] + kinds[5]),
        kinds[6] / n,
        kinds[7] / n,
        min(1.0, (n - kinds[6]) / w / 32),
        (len(set(words)) / w) ** 2,
        (len(set(lines)) / len(lines)) ** 2,
        kinds[8] / n,
        sum(len(x) > 20 for x in words) / w,
        sum(map(eq, words, words[1:])) / w,
    ]
    bins = [min(BINS - 1, len(raw).bit_length()), *(min(BINS - 1, int(s**0.5 * BINS)) for s in shares)]
    return [k * BINS + b for k, b in enumerate(bins)]


def meta_features(lang: str = "lang", source: str = "source", length: str = "n_chars") -> Column:
    """Numbers for language, source and stated length."""

    def hashed(name: str, first: int) -> Column:
        return (F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("\0")).cast("binary")), F.lit(HASHED)) + first).cast("int")

    bits = F.coalesce(F.least(F.floor(F.log2(F.greatest(F.col(length).cast("double"), F.lit(1.0)))), F.lit(14)) + 1, F.lit(0)).cast("int")
    return F.array(bits, hashed(lang, 16), hashed(source, 16 + HASHED))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with its columns and the numbers of both views in `_q_content` and `_q_meta`."""
    rows = docs.withColumn("_q_meta", meta_features())
    at = rows.columns.index(text)

    def run(batches):
        for batch in small_batches(batches, 1024, at):
            found = [content_features(t) for t in texts_of(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32()))], [*batch.schema.names, "_q_content"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, _q_content array<int>")


@dataclass
class Model:
    """Weights of both views by feature number, and the logistic function over both margins."""

    content: list[float] = field(default_factory=list)
    meta: list[float] = field(default_factory=list)
    mix: tuple[float, float, float] = (0.0, 0.0, 20.0)

    @property
    def known(self) -> bool:
        """Whether there were labels of both classes."""
        return bool(self.content)


def _margin(numbers: str, weights: list[float]) -> Column:
    table = F.lit([float(w) for w in weights])
    return F.aggregate(F.col(numbers), F.lit(0.0), lambda s, k: s + F.element_at(table, k + 1))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def fit(rows: DataFrame) -> Model:
    """Co-train on `rows` (_q_content, _q_meta, _q_fold, _q_label: 0, 1 or null); runs jobs.

    `rows` is read several times; pass a written table.
    """
    known = {r["_q_label"]: r["count"] for r in rows.where("_q_label is not null").groupBy("_q_label").count().collect()}
    if not known.get(0) or not known.get(1):
        share = (known.get(1, 0) + 1e-9) / (sum(known.values()) + 1e-9)
        return Model(mix=(0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))))
    prior = np.log(known[1] / known[0])
    learns = F.when(F.coalesce("_q_fold", F.lit(0)) != 1, F.col("_q_label"))
    content, meta = _weights(rows, {"_q_content": (learns, F.lit(1.0)), "_q_meta": (learns, F.lit(1.0))}, prior)
    for _ in range(ROUNDS):
        p = {}
        for name, weights in (("_q_content", content), ("_q_meta", meta)):
            slope, shift = _calibrated(rows, [_margin(name, weights)])[0::2]
            p[name] = _sigmoid(_margin(name, weights) * slope + shift)
        given = {}
        for to, by in (("_q_content", "_q_meta"), ("_q_meta", "_q_content")):
            borrowed = F.when(F.col("_q_label").isNull(), F.when(p[by] >= SURE, F.lit(1)).when(p[by] <= 1 - SURE, F.lit(0)))
            given[to] = (F.coalesce(learns, borrowed), F.when(F.col("_q_label").isNull(), F.lit(BORROWED)).otherwise(F.lit(1.0)))
        content, meta = _weights(rows, given, prior)
    model = Model(content, meta)
    model.mix = _calibrated(rows, [_margin("_q_content", content), _margin("_q_meta", meta)])
    return model


def _weights(rows: DataFrame, given: dict[str, tuple[Column, Column]], prior: float) -> tuple[list[float], list[float]]:
    """Log-odds of each feature number in both views, from weighted counts per label."""
    tagged = []
    for name, (label, weight) in given.items():
        first = "0" if name == "_q_content" else str(len(CONTENT) * BINS)
        tagged.append(F.struct(label.alias("y"), weight.alias("w"), F.expr(f"transform({name}, k -> k + {first})").alias("k")))
    each = rows.select(F.explode(F.array(*tagged)).alias("v")).where("v.y is not null").select("v.y", "v.w", F.explode("v.k").alias("k"))
    counts = np.ones((2, len(CONTENT) * BINS + META_SIZE)) * 0.5
    for r in each.groupBy("y", "k").agg(F.sum("w").alias("n")).collect():
        counts[int(r.y > 0), r.k] += r.n
    out = []
    borders = [range(k * BINS, (k + 1) * BINS) for k in range(len(CONTENT))]
    first = len(CONTENT) * BINS
    borders += [range(first, first + 16), range(first + 16, first + 16 + HASHED), range(first + 16 + HASHED, first + META_SIZE)]
    weights = np.zeros(counts.shape[1])
    for part in borders:
        c = counts[:, part]
        weights[part] = np.log(c[1] / c[1].sum()) - np.log(c[0] / c[0].sum())
    out = weights[:first] + prior / len(CONTENT), weights[first:] + prior / 3
    return out[0].tolist(), out[1].tolist()


def _calibrated(rows: DataFrame, margins: list[Column]) -> tuple[float, float, float]:
    """Logistic function through the labelled rows left for calibration: (slope, slope, shift)."""
    cells = [F.floor((F.least(F.greatest(m, F.lit(-REACH)), F.lit(REACH)) + REACH) * (CELLS / (2 * REACH))).cast("int") for m in margins]
    cells += [F.lit(CELLS // 2)] * (2 - len(cells))
    found = rows.where("_q_fold = 1 and _q_label is not null").groupBy(cells[0].alias("a"), cells[1].alias("b"), "_q_label").count().collect()
    if len({r["_q_label"] for r in found}) < 2:
        return 1.0 / len(margins), 1.0 / len(margins) if len(margins) > 1 else 0.0, 0.0
    x = np.array([[(r.a + 0.5) / CELLS * 2 * REACH - REACH, (r.b + 0.5) / CELLS * 2 * REACH - REACH, 1.0] for r in found])
    if len(margins) < 2:
        x[:, 1] = 0
    y, n = np.array([float(r["_q_label"] > 0) for r in found]), np.array([float(r["count"]) for r in found])
    w, hold = np.array([0.5, 0.0, 0.0]), np.array([1e-2, 1e-2, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (y - p)) - hold * w
        h = (x * (n * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(h, g)
        w = w + step * min(1.0, 2 / max(abs(step).max(), 1e-12))
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1]), float(w[2])


def labels_of(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(key, _q_label) with one row per id; of contradicting labels the largest counts."""
    return labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_q_label"))


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Features of all rows, written once, with the labels of those for which `train` holds."""
    few = labels.count() <= BROADCAST_LABELS
    known = labels_of(labels)
    rows = features(docs.select(key, text, "lang", "source", "n_chars")).withColumn("_q_fold", fold(key))
    rows = rows.join(F.broadcast(known) if few else known, key, "left").withColumn("_q_label", F.when(train, F.col("_q_label")))
    return materialize(rows.select(key, "_q_content", "_q_meta", "_q_fold", "_q_label"), "quality")


def with_scores(rows: DataFrame, model: Model) -> DataFrame:
    """Scores of both views and of their mix; `rows` holds the features."""
    if not model.content:
        none = F.lit(0.0)
        return rows.withColumns({"content_margin": none, "meta_margin": none, "score": _sigmoid(F.lit(model.mix[2]))})
    content, meta = _margin("_q_content", model.content), _margin("_q_meta", model.meta)
    a, b, c = model.mix
    return rows.withColumns({"content_margin": content, "meta_margin": meta}).withColumn(
        "score", _sigmoid(F.col("content_margin") * a + F.col("meta_margin") * b + c)
    )


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "_q_score") -> DataFrame:
    """All rows and columns of `docs`, with the probability of good quality in column `to`."""
    content, meta = (_margin("_q_content", model.content), _margin("_q_meta", model.meta)) if model.content else (F.lit(0.0), F.lit(0.0))
    a, b, c = model.mix
    return features(docs, text).withColumn(to, _sigmoid(content * a + meta * b + c)).drop("_q_content", "_q_meta")
