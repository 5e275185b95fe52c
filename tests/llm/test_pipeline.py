import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from meterlark.llm.queries import WORD_BPE

from .test_minhash import brute


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents whose fate is known: clean ones, toxic ones, junk, near copies and benchmark passages."""
    rng = random.Random(11)
    vocabulary = [f"word{k}" for k in range(400)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."

    benchmark = [text(30) for _ in range(20)]
    rows, labels, fate = [], [], {}

    def add(body, kind, toxic=0, good=1):
        k = len(rows)
        rows.append((k, body, "en", f"s{k % 7}", len(body or ""), "extra"))
        fate[k] = kind
        if k % 2 == 0:
            labels.append((k, good, toxic))

    for _ in range(700):
        add(text(rng.randint(30, 90)), "clean")
        words = text(rng.randint(30, 60)).split()
        for _ in range(3):
            words[rng.randrange(1, len(words))] = rng.choice(["vile", "foul", "nasty"])
        add(" ".join(words), "toxic", toxic=1)
        add(" ".join(w.upper() + "!!%%$$" for w in text(40).split()), "junk", good=0)
    for _ in range(30):
        base = text(80)
        add(base, "original")
        for _ in range(3):
            words = base.split()
            words[rng.randrange(len(words))] = "changed"
            add(" ".join(words), "copy")
        add(text(40) + " " + rng.choice(benchmark) + " " + text(20), "leak")
    add(None, "empty")
    add("", "empty")
    folder = tmp_path_factory.mktemp("corpus")
    frames = {
        "documents": (rows, "doc_id long, text string, lang string, source string, n_chars long, held_items string"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (list(enumerate(benchmark)), "item_id long, text string"),
    }
    for name, (data, schema) in frames.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder), rows, fate


def test_stages_keep_and_drop_what_they_should(spark, corpus):
    folder, rows, fate = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        docs = pipeline.materialize(out, name)
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}

    def kinds(ids):
        return {kind: sum(fate[k] == kind for k in ids) for kind in set(fate.values())}

    every, after = kinds(fate), [kinds(left[name]) for name, _ in pipeline.STAGES[:-1]]
    toxic, quality, near, clean = after
    assert toxic["toxic"] <= 0.05 * every["toxic"] and toxic["clean"] >= 0.98 * every["clean"] and toxic["empty"] == 2
    assert quality["junk"] <= 0.02 * every["junk"] and quality["clean"] >= 0.98 * toxic["clean"]
    texts = {k: t for k, t, *_ in rows}
    component, _ = brute([(k, texts[k]) for k in sorted(left["quality"])], 5)
    assert left["near_duplicates"] == {k for k in left["quality"] if component[k] == k}
    assert near["original"] + near["copy"] == len({component[k] for k in left["quality"] if fate[k] in ("original", "copy")})
    assert clean["leak"] == 0 and clean["clean"] == near["clean"]


def test_run_encodes_what_is_left(spark, corpus):
    folder, rows, fate = corpus
    library = Tokenizer.from_file(WORD_BPE)
    texts = {k: t or "" for k, t, *_ in rows}
    got = pipeline.run(spark, folder).collect()
    assert len(got) > 600
    for r in got:
        assert np.array(r.ids).tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_empty_documents(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def small(spark, folder, labels, n=20, extra=""):
    """Ordinary documents, one of them very long and one twice, with columns of clashing names."""
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcdefgh") * rng.randint(2, 7) for _ in range(40)), "en", "s", 9, 1, 2, 3) for k in range(n)]
    rows[3] = (3, rows[3][1] + " long words" * 40_000, *rows[3][2:])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _toxic int, _score int, _held int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_class_reject_only_their_own_documents(spark, tmp_path, label):
    docs = small(spark, tmp_path, [(k, 1 - label, label) for k in range(5)])
    for stage in (pipeline.without_toxic, pipeline.of_good_quality):
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == list(range(5 * label, 20))


def test_no_labels_and_clashing_columns(spark, tmp_path):
    docs = small(spark, tmp_path, [])
    for _, stage in pipeline.STAGES[:4]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and kept.count() == 20
    assert pipeline.run(spark, str(tmp_path)).count() == 20


def test_repeated_and_null_ids(spark, tmp_path):
    docs = small(spark, tmp_path, [(k, k % 2, k % 2) for k in range(10)])
    odd = docs.unionAll(docs.limit(5)).unionAll(docs.selectExpr("cast(null as long)", "null", *docs.columns[2:]).limit(2))
    for name, stage in pipeline.STAGES[:4]:
        kept = stage(spark, odd, str(tmp_path)).collect()
        assert all(r.doc_id is None or 0 <= r.doc_id < 20 for r in kept), name
    assert sum(r.doc_id is None for r in pipeline.without_near_copies(spark, odd, str(tmp_path)).collect()) == 2
