"""Pairs of sets that share many signatures: each is looked at once, and large groups of near copies give a forest of them."""

import random

import numpy as np
from pyspark.sql import DataFrame

from acoustic_spark.llm import jaccard

N_SETS, N_SIGNATURES = 60, 40


def near_copies(spark):
    """Sets that differ in one token each and share all signatures, in a component of their own each."""
    tokens = np.arange(100, dtype=np.uint64)
    sets = [(n, 100, bytearray(jaccard.bitmap(np.append(tokens[1:], np.uint64(500 + n))).tobytes())) for n in range(N_SETS)]
    shared = [(1_000 * s, n, n) for s in range(N_SIGNATURES) for n in range(N_SETS)]
    return spark.createDataFrame(shared, "signature long, number long, component long").repartition(4), spark.createDataFrame(sets, "number long, n_shingles long, bits binary")


def test_a_pair_of_many_signatures_is_given_once(spark, monkeypatch):
    open_, sets = near_copies(spark)
    monkeypatch.setattr(DataFrame, "distinct", lambda self: self)
    rows = jaccard.block_pairs(open_, sets, 85).collect()
    assert sorted((r.a, r.b) for r in rows) == [(a, b) for a in range(N_SETS) for b in range(a + 1, N_SETS)]


def test_a_large_group_gives_a_forest_and_says_so(spark):
    open_, sets = near_copies(spark)
    rows = jaccard.block_pairs(open_, sets, 85, few=4).collect()
    pairs = [(r.a, r.b) for r in rows if r.signature is None]
    component = list(range(N_SETS))
    for a, b in pairs:
        component = [component[a] if c == component[b] else c for c in component]
    assert len(pairs) == N_SETS - 1 and len(set(component)) == 1
    assert [(r.a, r.b, r.signature) for r in rows if r.signature is not None] == [(None, None, 0)]


def test_forest_takes_the_nearest_edges():
    a, b = np.array([1, 1, 2, 7, 2]), np.array([2, 3, 3, 8, 1])
    assert sorted(jaccard.forest(a, b, np.array([0.3, 0.1, 0.2, 0.5, 0.4])).tolist()) == [1, 2, 3]


def test_rounds_of_forests_find_the_same_components(spark, monkeypatch):
    """Chains and groups of copies with a few words changed, against all pairs compared; a forest is all that the first rounds give."""
    random.seed(5)
    base = [[f"{c}{i}" for i in range(80)] for c in "abc"]
    texts = []
    for words in base:
        for _ in range(25):
            changed = list(words)
            for at in random.sample(range(80), random.randint(0, 5)):
                changed[at] = f"x{random.randint(0, 3)}"
            texts.append(" ".join(changed))
    sets = [jaccard.shingles(jaccard.words_of(t), jaccard.WordHashes(b""))[0] for t in texts]
    smallest = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if jaccard.similar(sets[i], sets[j]):
                low, high = sorted((smallest[i], smallest[j]))
                smallest = [low if x == high else x for x in smallest]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "FEW", (0, 0, None))
    found = {r.doc_id: r.component_id for r in jaccard.join_similar(docs).collect()}
    assert found == dict(enumerate(smallest)) and len(set(smallest)) > 3
