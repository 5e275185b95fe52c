import hashlib
import random
import zlib

import numpy as np
import pytest

from meterlark.llm import prefixtrie
from meterlark.llm.queries import op11_prefix_trie


def brute(rows, rebuild=True):
    """Every node from all prefixes in one dictionary."""
    own = {}
    for k, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if k is not None:
            own.setdefault(k, []).append((role or "", text or ""))
    whole = own
    if rebuild:
        whole = {}
        for k in own:
            base, h = own.get(k - k % 100, []), zlib.crc32(str(k).encode()) % 6
            whole[k] = base[:h] + own[k][h:]
    members = {}
    for k, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(k)
    children, leaves, saved = ({p: 0 for p in members} for _ in range(3))
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, ks in members.items():
        ends = ",".join(str(k) for k in sorted(ks) if len(whole[k]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(ks), len(p), parent, len(ks), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n long")


def check(nodes):
    return sorted(map(tuple, nodes.collect()), key=repr)


def conversations(seed, n, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        rows += [(3 * k, t, rng.choice(["user", "bot"]) if t else "user", "x" * rng.randint(1, words)) for t in range(rng.randint(1, longest))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "shard"), [(64, 100_000), (64, 7), (3, 100_000), (2, 5), (1, 1)])
def test_equals_all_prefixes(spark, segment, shard):
    rows = conversations(1, 120, 9)
    df = frame(spark, rows).repartition(3)
    assert check(prefixtrie.rebuilt_prefixes(df, segment=segment, shard=shard)) == brute(rows)


def test_conversations_as_they_are_and_many_copies(spark):
    rows = conversations(2, 60, 6, 2) + [(1000 + k, t, "user", "same " * t) for k in range(50) for t in range(5)]
    for segment, shard in ((64, 30), (5, 12), (4, 50)):
        assert check(prefixtrie.prefixes(frame(spark, rows), segment=segment, shard=shard)) == brute(rows, False)


def test_one_long_conversation(spark):
    rows = [(7, t, "user", "ab"[t % 2]) for t in range(700)] + [(8, t, "user", "ab"[t % 2]) for t in range(300)] + [(9, 0, "user", "b")]
    assert check(prefixtrie.prefixes(frame(spark, rows))) == brute(rows, False)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (5, None, None, None), (5, 2, "", ""), (5, 3, "bot", None), (-7, 0, "user", "né \U0001f600"), (-107, 1, "user", "x")]
    rows += [(200, 1, "user", "twice"), (200, 1, "user", "twice"), (201, 1, "user", "twice"), (299, 4, "user", "long " * 20_000), (700, None, "a", "b"), (701, 9, "a", "b")]
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert check(prefixtrie.rebuilt_prefixes(frame(spark, positive))) == brute(positive)
    assert check(prefixtrie.prefixes(frame(spark, rows))) == brute(rows, False)
    assert check(prefixtrie.rebuilt_prefixes(frame(spark, rows).where("false"))) == []


def test_query_over_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert check(op11_prefix_trie(spark, sf_dir)) == brute(rows)


def test_findclose_over_many_blocks():
    rng = np.random.default_rng(1)
    bits, depth = [], 0
    while len(bits) < 60_000 or depth:
        up = depth < 1 or (len(bits) < 60_000 and rng.random() < 0.52)
        bits.append(int(up))
        depth += 1 if up else -1
    tree = prefixtrie.Parentheses(np.array(bits, np.uint8))
    stack, want = [], {}
    for k, b in enumerate(bits):
        if b:
            stack.append(k)
        else:
            want[stack.pop()] = k
    assert all(tree.findclose(k) == c for k, c in want.items())
    assert tree.leaves_before()[-1] == sum(a and not b for a, b in zip(bits, bits[1:], strict=False))
