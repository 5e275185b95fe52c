import zlib
from collections import Counter

import numpy as np
import pytest

from meterlark.llm import sharding
from meterlark.llm.queries import op12_sharding


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 16, 17, 1000, 10_007])
def test_permutations_are_whole_and_turn_back(rows):
    p = sharding.Permutation(rows, 3)
    places = p.places(np.arange(rows))
    assert sorted(places.tolist()) == list(range(rows))
    assert p.numbers(places).tolist() == list(range(rows))
    assert p.number_at(int(places[rows // 2]) % 4, int(places[rows // 2]) // 4, 4) == rows // 2
    if rows > 100:
        other = sharding.Permutation(rows, 4).places(np.arange(rows))
        assert abs(np.corrcoef(np.arange(rows), places)[0, 1]) < 0.1 and (other != places).mean() > 0.9
    with pytest.raises(ValueError, match="not below"):
        p.places(np.array([rows]))


def test_permutations_of_very_many_rows():
    p = sharding.Permutation(10**13, 1)
    some = np.random.default_rng(0).integers(0, 10**13, 1000)
    assert p.numbers(p.places(some)).tolist() == some.tolist()


def brute(rows, shards, seed=0):
    """Shard and slot by sorting all rows; rows of one key and text share theirs."""
    places = sharding.Permutation(len(rows), seed).places(np.arange(len(rows))).tolist()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    return [(k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), p % shards, p // shards) for (k, t), p in zip(ordered, places, strict=True)]


def test_equals_sorting_all_rows(spark):
    rows = [(7 * k % 101, f"text {k} ü" * (k % 5)) for k in range(101)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, shard int")
    want = sorted(brute(rows, 6, 5))
    for layout in (docs, docs.repartition(5), docs.coalesce(1)):
        assert sorted(map(tuple, sharding.assign(layout, 6, 5).collect())) == want


def test_odd_rows(spark):
    rows = [(None, "a"), (None, None), (3, None), (3, ""), (3, "long " * 50_000), (-1, "x")] + [(9, "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.assign(docs, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((k, n, c) for k, n, c, _, _ in brute(rows, 4))
    assert {(r.shard, r.slot) for r in got} == {(p % 4, p // 4) for p in range(len(rows))}
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, sharding.assign(docs.repartition(7), 4).collect()), key=repr)
    assert sharding.assign(docs.where("false"), 4).count() == 0


def test_query_is_even_without_gaps(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_sharding(spark, sf_dir).collect()
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in counts)
    assert sorted((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == sorted(brute(list(docs.items()), 24))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_written_shards_hold_all_rows_and_columns(spark):
    docs = spark.createDataFrame([(k % 30, f"t{k}", k) for k in range(100)], "doc_id long, text string, more int")
    back = spark.read.parquet(sharding.write(docs, 3, 2))
    assert sorted(map(tuple, back.select("doc_id", "text", "more").collect())) == sorted(map(tuple, docs.collect()))
    assert Counter(r.shard for r in back.collect()) == {0: 34, 1: 33, 2: 33}
    with pytest.raises(ValueError, match="in the way"):
        sharding.write(back, 3)
