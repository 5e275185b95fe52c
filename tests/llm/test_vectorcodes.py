import hashlib
import math
import random

import numpy as np
import pytest

from meterlark.llm import vectorcodes
from meterlark.llm.queries import op13_vector_codes


def brute(rows, parts=16, entries=64, rounds=2):
    """The same by comparing every part with every entry, in Python's integers."""
    kept = [(k, y, [math.floor(256 * a) for a in x]) for k, x, y in rows if x is not None and all(a is not None and math.isfinite(a) for a in x)]
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, _, v in kept:
                members[nearest(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else e for m, e in zip(members, books[p], strict=True)]
    out = []
    for k, y, v in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        out.append((k, y, "".join(f"{n:02x}" for _, n in found), sum(d for d, _ in found)))
    per = {}
    for _, y, _, e in out:
        per[y] = per.get(y, 0) + e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((k, code, e, per[y], sha) for k, y, code, e in out), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(k, x, y, "x") for k, x, y in rows], "vec_id long, embedding array<float>, label int, code string")


def check(spark, rows, parts=4):
    df = frame(spark, rows).repartition(parts)
    return sorted(map(tuple, vectorcodes.report(df).collect()), key=repr)


def vectors(seed, n, d=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, d)) * 0.3
    x = (centres[rng.integers(0, 9, n)] + rng.standard_normal((n, d)) * 0.05).astype(np.float32)
    return [(int(k), [float(a) for a in v], int(k) % 5 if k % 7 else None) for k, v in zip(rng.permutation(n), x, strict=True)]


@pytest.mark.parametrize("block", [4, 32])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectorcodes, "CHUNK", 100)
    monkeypatch.setattr(vectorcodes, "BLOCK", block)
    rows = vectors(1, 500)
    assert check(spark, rows) == check(spark, rows, 1) == brute(rows)


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op13_vector_codes(spark, sf_dir).collect()), key=repr) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(4)
    some = [rng.choice([-0.5, 0.0, 0.25]) for _ in range(16)]
    rows = [(k, [rng.choice([-1.5, -0.001, 0.0, 1.0]) for _ in range(16)], k % 3) for k in range(90)]
    rows += [(1000, None, 1), (1001, [None] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [float("-inf")] * 16, None)]
    rows += [(None, some, None), (5, some, None), (5, some, None)] + [(2000, some, 7)] * 60
    assert check(spark, rows) == check(spark, rows, 1) == brute(rows)


def test_fewer_vectors_than_entries(spark):
    rows = vectors(2, 5, 16)
    assert check(spark, rows) == brute(rows)


def test_empty_table_and_other_lengths(spark):
    assert check(spark, []) == check(spark, [(1, None, 1)]) == []
    rows = [(k, [float(k)] * 18, k) for k in range(4)]
    got = check(spark, [*rows, (9, [1.0], 0), (10, [], None)])
    assert [r[1:4] for r in got if r[0] in (9, 10)] == [(None, None, None), (None, None, 0)]
    assert {r[2] for r in got if r[0] < 4} == {0}
    with pytest.raises(Exception, match="beyond"):
        check(spark, [(1, [1e9] * 16, 1)])


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(3)
    points = (rng.standard_normal((20_000, 4)) * 40).astype(int)
    entries = points[:64]
    block = vectorcodes.Blocks.of(points)
    far = ((block.points[:, None] - entries[None]) ** 2).sum(2)
    short = np.repeat(block.shortlists(entries), vectorcodes.BLOCK, 0)[:20_000]
    assert short[far == far.min(1, keepdims=True)].all() and short.mean() < 0.75
    entry, best, _ = block.assign(entries, True)
    assert (entry == far.argmin(1)).all() and (best == far.min(1)).all()


def test_hilbert_neighbours_are_one_step_apart():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = grid[np.argsort(vectorcodes.hilbert(grid), kind="stable")]
    steps = np.abs(np.diff(order, axis=0)).sum(1)
    assert steps.mean() < 1.6
