import random

import pytest
from pyspark.sql import functions as F

from meterlark.llm import quality


def frames(spark, n=1500):
    rng = random.Random(9)
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(["plain", "words", "of", "a", "usual", "text", "that", "reads", "well"]) + str(rng.randrange(9)) * (rng.random() < 0.1) for _ in range(rng.randint(10, 60))]
        good = k % 5 != 0
        if not good:
            words = rng.choice([[w.upper() + "!!" for w in words], [w + "$$%" for w in words], words[:3] * 20, [words[0]] * 40])
        # The source tells something, too.
        source = f"s{rng.randrange(4)}" if good else f"s{rng.randrange(3, 8)}"
        text = " ".join(words)
        docs.append((k, text, "en", source, len(text), "clash"))
        if k % 3:
            labels.append((k, int(good)))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, quality string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = frames(spark)
    return quality.fit(quality.training_rows(docs, labels, F.coalesce(quality.fold() != 0, F.lit(True))))


def test_held_out_rows_are_told_apart(spark, model):
    docs, labels = frames(spark)
    got = quality.score(docs, model).where(quality.fold() == 0).select("doc_id", "_q_score").join(labels, "doc_id").collect()
    assert len(got) > 100 and sum((r["_q_score"] >= 0.5) == bool(r.quality) for r in got) >= 0.97 * len(got)


def test_views_learn_from_each_other(spark):
    """Without any label that links source and quality, rounds of exchange teach it to the metadata."""
    docs, labels = frames(spark)
    few = labels.where(F.col("doc_id") % 7 == 0)
    rows = quality.training_rows(docs, few, F.lit(True))
    first = len(quality.CONTENT) * quality.BINS
    assert first == len(quality.content_features("a")) * quality.BINS
    both = quality.with_scores(rows, quality.fit(rows)).join(labels, "doc_id")
    means = {r.quality: r.m for r in both.groupBy("quality").agg(F.avg("meta_margin").alias("m")).collect()}
    assert means[1] > means[0] + 0.5


def test_features_are_numbered_by_feature():
    for text in ("", " \n", "A" * 100000, "x y\nx y", "é 🙂 $$$", "a a a a"):
        assert [n // quality.BINS for n in quality.content_features(text)] == list(range(len(quality.CONTENT)))


def test_odd_rows(spark, model):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (None, "plain words", "xx", "new", -5), (3, "plain words of a text " * 20000, "en", "s1", 1), (3, "plain", "en", "s1", 1), (3, "plain", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = quality.score(docs, model)
    assert got.columns == [*docs.columns, "_q_score"] and got.count() == 6
    assert all(0 <= r["_q_score"] <= 1 for r in got.collect())
    assert quality.score(docs.where("false"), model).count() == 0


def test_without_labels_nothing_is_rejected(spark):
    docs, labels = frames(spark, 20)
    for some in (labels.where("false"), labels.where("quality = 1")):
        rows = quality.training_rows(docs, some, F.lit(True))
        none = quality.fit(rows)
        assert not none.content
        assert {r.score >= 0.5 for r in quality.with_scores(rows, none).collect()} == {True}
    assert quality.fit(quality.training_rows(docs.where("false"), labels, F.lit(True))).content == []
