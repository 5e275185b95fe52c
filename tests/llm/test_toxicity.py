import math
import random
from collections import Counter

import pytest

from meterlark.llm import toxicity


def frames(spark, n=3000):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(30)]
    docs, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = k % 4 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["vile", "foul"])
        docs.append((k, " ".join(text), "x"))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_texts_are_told_apart(spark):
    docs, labels = frames(spark)
    train = toxicity.labelled(docs, labels, "toxic").where(toxicity.fold() != 0)
    model = toxicity.fit(train)
    got = toxicity.score(docs.drop("score"), model).where(toxicity.fold() == 0).join(labels, "doc_id").collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in got) >= 0.9 * len(got)


def test_odd_rows(spark):
    docs, labels = frames(spark)
    model = toxicity.fit(toxicity.labelled(docs, labels, "toxic"))
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "vile"), (2, "w1 " * 20000), (2, "w1 " * 20000)], "doc_id long, text string")
    got = {(r.doc_id, r.text): r.score for r in toxicity.score(odd, model).collect()}
    assert len(got) == 4 and got[1, None] == got[1, ""] and all(0 <= s <= 1 for s in got.values())
    assert got[None, "vile"] > 0.5 > got[1, ""]


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, 8)
    none = toxicity.fit(toxicity.labelled(docs, labels.where("toxic > 9"), "toxic"))
    assert {r.score < 0.001 for r in toxicity.score(docs, none, to="p").withColumnRenamed("p", "score2").selectExpr("score2 as score").collect()} == {True}
    assert toxicity.score(docs.where("false"), none, to="p").count() == 0
    one = toxicity.fit(toxicity.labelled(docs, labels.where("toxic = 0"), "toxic"))
    assert one.slopes == (0, 0)


def test_contradicting_and_null_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1)], "doc_id long, toxic int")
    assert [tuple(r) for r in toxicity.labelled(docs, labels, "toxic").collect()] == [(1, "a", 1)]


def brute(train, asked):
    """(peak, mean) of each text by the formulas, from sets of pairs."""
    seen = {0: set(), 1: set()}
    for text, label in train:
        words = text.lower().split()
        seen[label] |= set(zip([None, *words], words, strict=False))
    k = {c: Counter(v for _, v in pairs) for c, pairs in {**seen, 2: seen[0] | seen[1]}.items()}
    total = {c: sum(n.values()) for c, n in k.items()}
    d = {0: toxicity.DISCOUNT, 1: toxicity.DISCOUNT, 2: toxicity.SHARED_DISCOUNT}
    left = {c: sum(min(n, d[c]) for n in k[c].values()) / total[c] for c in k}

    def difference(v):
        shared = max(k[2][v] - d[2], 0) / total[2] + left[2] / (1 + len(k[2]))
        p = [max(k[c][v] - d[c], 0) / total[c] + left[c] * shared for c in (0, 1)]
        return math.log(p[1] / p[0])

    out = []
    for text in asked:
        x = [difference(v) for v in text.lower().split()]
        s = toxicity.STRETCH
        runs = [sum(x[i : i + s]) / s for i in range(max(1, len(x) - s + 1))]
        out.append((max(runs), sum(x) / max(s, len(x))))
    return out


def test_scores_equal_the_formulas(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(14)]
    rows = [(k, " ".join(rng.choice(words[: 14 - 5 * (k % 2)]) for _ in range(rng.randint(0, 9))), k % 2) for k in range(150)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(train)
    asked = [t for _, t, _ in rows] + ["never seen", "", "W1 w13 W13 never", *words]
    folds = {r.doc_id: r.f for r in train.select("doc_id", toxicity.fold().alias("f")).collect()}
    want = dict(zip(asked, brute([(t, y) for k, t, y in rows if folds[k] != 1], asked), strict=True))
    frame = spark.createDataFrame([(t,) for t in asked], "text string")
    for r in toxicity._scored(frame, "text", model).collect():
        assert (r._peak, r._mean) == pytest.approx(want[r.text], abs=1e-5)
    (a, b), c = model.slopes, model.shift
    for r in toxicity.score(frame, model).collect():
        assert r.score == pytest.approx(1 / (1 + math.exp(-a * want[r.text][0] - b * want[r.text][1] - c)), abs=1e-4)


def test_more_labels_than_the_bound(spark):
    docs, labels = frames(spark, 400)
    train = toxicity.labelled(docs, labels, "toxic")
    model = toxicity.fit(train, most=200)
    assert model.known and toxicity.fit(train, most=1).known is False
    with pytest.raises(ValueError, match="in the way"):
        toxicity.score(docs, model)


def test_the_table_grows_with_the_words(spark):
    """A telling word counts however many others tell as much; a list of at most 1,024 words could not hold these."""
    rng = random.Random(9)
    toxic, plain = [[f"{kind}{k}" for k in range(4000)] for kind in "tp"]
    rows = [(k, " ".join(rng.choice(toxic if k % 2 else plain) for _ in range(60)), k % 2) for k in range(2000)]
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    single = [(w, 1) for w in toxic] + [(w, 0) for w in plain]
    got = toxicity._scored(spark.createDataFrame([(f"never{k} {w}", y) for k, (w, y) in enumerate(single)], "text string, y int"), "text", model)
    assert got.where("_mean != 0 and (_mean > 0) = (y = 1)").count() >= 0.99 * len(single)


def brute_after(train, asked):
    """(peak, mean) of each text by the formulas of all three levels, from the texts' sets of pairs."""
    seen = {0: Counter(), 1: Counter()}
    for text, label in train:
        words = text.lower().split()
        seen[label].update(set(zip([None, *words], words, strict=False)))
    k = {c: Counter(v for _, v in pairs) for c, pairs in {**seen, 2: seen[0] | seen[1]}.items()}
    d = {0: toxicity.DISCOUNT, 1: toxicity.DISCOUNT, 2: toxicity.SHARED_DISCOUNT}
    total = {c: sum(n.values()) for c, n in k.items()}
    left = {c: sum(min(n, d[c]) for n in k[c].values()) / total[c] for c in k}

    def likely(c, u, v):
        after = {w: n for (x, w), n in seen[c].items() if x == u}
        shared = max(k[2][v] - d[2], 0) / total[2] + left[2] / (1 + len(k[2]))
        word = max(k[c][v] - d[c], 0) / total[c] + left[c] * shared
        if not after:
            return word
        taken = sum(min(n, toxicity.PAIR_DISCOUNT) for n in after.values())
        return (max(after.get(v, 0) - toxicity.PAIR_DISCOUNT, 0) + taken * word) / sum(after.values())

    out, s = [], toxicity.STRETCH
    for text in asked:
        words = text.lower().split()
        x = [math.log(likely(1, u, v) / likely(0, u, v)) for u, v in zip([None, *words], words, strict=False)]
        out.append((max(sum(x[i : i + s]) / s for i in range(max(1, len(x) - s + 1))), sum(x) / max(s, len(x))))
    return out


def test_scores_of_pairs_equal_the_formulas(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(9)]
    rows = [(k, " ".join(rng.choice(words[: 9 - 4 * (k % 2)]) for _ in range(rng.randint(0, 12))), k % 2) for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    model = toxicity.fit(train, pairs=True)
    asked = [t for _, t, _ in rows] + ["never seen w1", "", "W1 w1 W8 never", *(f"{u} {v}" for u in words for v in words)]
    folds = {r.doc_id: r.f for r in train.select("doc_id", toxicity.fold().alias("f")).collect()}
    used = [(t, y) for k, t, y in rows if folds[k] != 1]
    want = dict(zip(asked, brute_after(used, asked), strict=True))
    assert want != dict(zip(asked, brute(used, asked), strict=True))
    for r in toxicity._scored(spark.createDataFrame([(t,) for t in asked], "text string"), "text", model).collect():
        assert (r._peak, r._mean) == pytest.approx(want[r.text], abs=1e-5)


def test_words_that_only_their_order_tells_apart(spark):
    """Both classes hold the same words; in toxic texts one order of two of them is frequent."""
    rng = random.Random(13)
    rows = []
    for k in range(1500):
        text = [f"w{rng.randrange(30)}" for _ in range(12)]
        text[3:3] = ["you", "bad"] if k % 2 else ["bad", "you"]
        rows.append((k, " ".join(text), k % 2))
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(train.where(toxicity.fold() != 0), pairs=True)
    got = toxicity.score(train.where(toxicity.fold() == 0), model).collect()
    assert sum((r.score >= 0.5) == bool(r.label) for r in got) >= 0.95 * len(got)
