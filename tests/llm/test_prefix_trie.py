"""The trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from acoustic_spark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, pos string, size string"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).hexdigest(), text or ""))
    whole = {}
    for conv in own:
        own[conv].sort()
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        family = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        whole[conv] = tuple((role, text) for _, _, role, _, text in own.get(family, [])[:h] + own[conv][h:])
    members = defaultdict(list)
    for conv, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
            leaves[p[:d]] += children[p] == 0
    return [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    ]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(3)
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(df)).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)


def test_awkward(spark):
    rows = [(None, 1, "user", "no conversation"), (0, None, None, None), (0, 1, "user", "hi"), (0, 1, "user", "hi"), (0, 1, "user", "ho"), (0, 2, None, "x" * 100_000)]
    rows += [(c, t, "user", f"t{t}") for c in (1, 2, 7, 55, -3, -120, 101, 250) for t in range(c % 4)]
    rows += [(300 + c, t, "é", "same 𝛼") for c in range(30) for t in range(9)]
    check(spark, rows)
    check(spark, [(5, 0, "user", "alone")])
    check(spark, [])


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_long_conversations_and_small_blocks(spark, batch):
    rng = random.Random(3)
    rows = []
    for c in range(0, 400, 3):
        turns = rng.choice([0, 1, 3, 6, 64, 65, 70, 128, 129, 200])
        rows += [(c, t, "user", "common" if rng.random() < 0.97 else f"own{rng.randrange(3)}") for t in range(turns)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_minima_search_both_sides():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 100):
        values = rng.integers(-1, 5, n)
        values[0] = -1
        table = prefix_trie.Minima(values)
        at = rng.integers(0, n, 200)
        depth = rng.integers(0, 6, 200)
        left, right = table.left(at, depth), table.right(at, depth)
        for i, d, a, b in zip(at, depth, left, right):
            assert a == max(j for j in range(i + 1) if values[j] < d)
            assert b == min([j for j in range(i + 1, n) if values[j] < d], default=n)
        begin = np.minimum(at, n - 1)
        end = begin + 1 + rng.integers(0, n, 200) % (n - begin)
        assert (table.least(begin, end) == [values[a:b].min() for a, b in zip(begin, end)]).all()
