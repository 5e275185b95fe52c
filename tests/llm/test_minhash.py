import random

import numpy as np

from meterlark.llm import minhash
from meterlark.llm.common import components


def sets_of(text, words):
    w = (text or "").encode().lower().split()
    n = min(words, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()


def brute(rows, words):
    """Component of each id, by comparing all pairs."""
    sets = [(k, sets_of(t, words)) for k, t in rows]
    parent = {k: k for k, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a == b or (x and y and 100 * len(x & y) >= 80 * len(x | y)):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {k: find(k) for k, _ in rows}, {k: len(x) for k, x in sets}


def near_copies(seed=3, originals=25, copies=12):
    rng = random.Random(seed)
    rows = []
    for _ in range(originals):
        base = [f"w{rng.randrange(900)}" for _ in range(rng.randint(30, 120))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 6)):
                text[rng.randrange(len(text))] = f"w{rng.randrange(900)}"
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    odd = [None, "", " \t\n", "one", "ONE", "one two", "One  two", "É a", "é a", "x\x1cy z", "a\x0bb\x0cc"]
    rows = list(enumerate(near_copies() + odd + ["long " + "word " * 9000] * 2))
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t in rows], "doc_id long, text string, v string, halves int")
    for words in (2, 5):
        want, n = brute(rows, words)
        got = minhash.near_duplicates(docs, words=words).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: r.component_id for r in got} == want
        assert {r.doc_id: r.n_shingles for r in got} == n
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_classes_that_meet_only_beside_the_smallest_are_linked(spark, monkeypatch):
    """Every class shares all keys, so each star compares with one class only."""
    monkeypatch.setattr(minhash, "AGREEING", 0)
    rows = list(enumerate(near_copies(8, 4, 10)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows, 2)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()} == want


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(7, "a b c"), (7, "d e f"), (3, "d e f"), (None, "d e f"), (9, "q"), (9, "q")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, words=2).collect()), key=repr)
    assert got == [(3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True), (9, 9, True), (None, None, True)]
    kept = sorted(map(tuple, minhash.deduplicate(docs, words=2).collect()), key=repr)
    assert kept == [(3, "d e f"), (9, "q"), (None, "d e f")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).count() == 0 and minhash.deduplicate(docs).count() == 0


def test_stars_cross_batches(spark):
    """Keys whose rows are cut by a batch give the same stars."""
    halves = [[7] * 20 if k % 3 else [k] * 20 for k in range(50)]
    classes = spark.createDataFrame([(k, h) for k, h in enumerate(halves)], "v long, halves array<long>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(map(tuple, minhash._star_pairs(classes).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(1, k, True) for k in range(2, 50) if k % 3]
    two = spark.createDataFrame([(4, [1] * 20), (9, [1] * 20)], "v long, halves array<long>")
    assert [tuple(r) for r in minhash._star_pairs(two).collect()] == [(4, 9, False)]


def test_tables_find_a_similar_pair_with_the_stated_probability():
    share = 1 - (1 - 0.8**minhash.ROWS) ** minhash.HALVES
    assert 1 - share**2 < 0.0001
    keys = minhash.table_keys(np.ones((1, 2 * minhash.HALVES), np.uint64))
    assert len(set(keys.ravel().tolist())) == minhash.HALVES**2


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 1)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 160)}}
