import numpy as np

from meterlark.llm import embeddings


def brute(rows):
    """Links and component per row, by all pairs."""

    def good(x):
        return x is not None and len(x) and all(a is not None and np.isfinite(a) for a in x) and any(x)

    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i, (k, x) in enumerate(rows):
        for j, (m, y) in enumerate(rows[:i]):
            if k is not None and m is not None and good(x) and good(y) and len(x) == len(y):
                a, b = np.array(x, float), np.array(y, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                linked[i, j] = linked[j, i] = a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    label = np.arange(n)
    while True:
        low = np.array([min([label[i], *label[linked[i]]]) for i in range(n)])
        if (low == label).all():
            break
        label = low
    least = {c: min(rows[i][0] for i in np.flatnonzero(label == c)) for c in set(label) if rows[c][0] is not None}
    return sorted(((rows[i][0], int(linked[i].sum()), least.get(label[i]), rows[i][0] is None or least[label[i]] == rows[i][0]) for i in range(n)), key=repr)


def vectors(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    x = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, d)) * rng.choice([0.02, 0.2, 1.0], n)[:, None]
    return [[float(np.float32(a)) for a in row] for row in x]


def check(spark, rows):
    frame = spark.createDataFrame([(k, x, 1) for k, x in rows], "vec_id long, embedding array<float>, v int")
    return sorted(map(tuple, embeddings.near_duplicates(frame).collect()), key=repr)


def test_equals_brute_force_with_odd_rows(spark):
    x = vectors(1)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1e-30] * 16, [1.0] * 16, [2.0] * 16, [1.0, 0.0], [1.0, 0.1], [0.0, 1.0]]
    rows = [(k * 3, v) for k, v in enumerate(x + odd + x[:40] + x[:1] * 5)] + [(None, x[0]), (3, x[1])]
    assert check(spark, rows) == brute(rows)


def test_blocks_count_each_link_once(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    monkeypatch.setattr(embeddings, "LEAF", 60)
    rows = list(enumerate(vectors(2, 200)))
    assert check(spark, rows) == brute(rows)


def test_recall_of_deep_trees(spark, monkeypatch):
    """Small leaves, pairs just above the threshold."""
    monkeypatch.setattr(embeddings, "LEAF", 40)
    rng = np.random.default_rng(5)
    a = rng.standard_normal((700, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((700, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    both = np.concatenate([a, 0.955 * a + np.sqrt(1 - 0.955**2) * b])
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(both)]
    got = {r[0]: r[1] for r in check(spark, rows)}
    assert sum(got[k] == 1 for k in range(700)) >= 0.99 * 700


def test_empty_table(spark):
    assert check(spark, []) == []
