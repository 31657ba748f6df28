"""Positions, top lists and selections against plain Python, with one hot key and tiny slices."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from acoustic_spark.operators import positions
from acoustic_spark.operators.pairing import balanced, balanced_by_label, mixed_batches, pair_by_position, shuffle_rows, shuffled_ranks, training_sets
from acoustic_spark.operators.positions import first_n, with_position
from acoustic_spark.operators.toplists import latest_per_key, recent_events, top_n_per_key


@pytest.fixture(scope="module")
def hot(spark):
    """600 rows, two thirds of them of one key, with gaps in the sequence."""
    rng = random.Random(5)
    seqs = rng.sample(range(5_000), 600)
    return [("hot" if rng.random() < 0.66 else f"k{rng.randrange(9)}", s, rng.randrange(7)) for s in seqs]


def by_key(rows):
    groups = defaultdict(list)
    for key, seq, value in rows:
        groups[key].append((seq, value))
    return {k: sorted(v) for k, v in groups.items()}


@pytest.mark.parametrize("slice_rows", [1, 64, 1 << 20])
def test_with_position(spark, hot, slice_rows, monkeypatch):
    monkeypatch.setattr(positions, "BLOCK_SLICES", 10)
    df = spark.createDataFrame(hot, "k STRING, seq BIGINT, v INT")
    got = {(r.k, r.seq): (r.i, r.n) for r in with_position(df, ["k"], "seq", slice_rows=slice_rows).collect()}
    want = {(k, s): (i, len(g)) for k, g in by_key(hot).items() for i, (s, _) in enumerate(g)}
    assert got == want


def test_positions_of_wide_numbers(spark):
    """Neighbouring numbers near the end of the BIGINT range stay apart."""
    seqs = [(1 << 62) + d for d in (0, 1, 2, 5)] + [-(1 << 62), -1, 0, 7]
    df = spark.createDataFrame([("a", s) for s in seqs], "k STRING, seq BIGINT")
    got = {r.seq: r.i for r in with_position(df, ["k"], "seq", slice_rows=2).collect()}
    assert got == {s: i for i, s in enumerate(sorted(seqs))}


@pytest.mark.parametrize("n", [1, 10, 10_000])
def test_first_n(spark, hot, n):
    df = spark.createDataFrame(hot, "k STRING, seq BIGINT, v INT")
    got = {(r.k, r.seq, r.i) for r in first_n(df, ["k"], "seq", n, slice_rows=50).collect()}
    assert got == {(k, s, i) for k, g in by_key(hot).items() for i, (s, _) in enumerate(g[:n])}


def test_top_n_and_latest(spark, hot):
    df = spark.createDataFrame(hot, "k STRING, seq BIGINT, v INT")
    top = top_n_per_key(df, ["k"], [F.desc("v"), F.asc("seq")], 4)
    want = {
        (k, s, r)
        for k, g in by_key(hot).items()
        for r, (s, _) in enumerate(sorted(g, key=lambda e: (-e[1], e[0]))[:4], 1)
    }
    assert {(r.k, r.seq, r["rank"]) for r in top.collect()} == want
    last = {(r.k, r.seq) for r in latest_per_key(df, ["k"], "seq").collect()}
    assert last == {(k, g[-1][0]) for k, g in by_key(hot).items()}
    assert top_n_per_key(df, ["k"], [F.desc("v"), F.asc("seq")], 5_000).count() == len(hot)


def test_top_n_is_limited_in_the_map_tasks(spark, hot):
    df = spark.createDataFrame(hot, "k STRING, seq BIGINT, v INT")
    plan = top_n_per_key(df, ["k"], [F.desc("v")], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_recent_events_ring(spark):
    rows = [("a", i, i) for i in range(25)] + [("b", i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "sensor_id STRING, ts INT, seq BIGINT")
    got = sorted((r.sensor_id, r["rank"], r.seq) for r in recent_events(df, ["sensor_id"], "ts", "seq").collect())
    assert got == [("a", r, 14 + r) for r in range(1, 11)] + [("b", r, r - 1) for r in range(1, 4)]


def test_unbalanced_pairs(spark):
    pos = spark.createDataFrame([(i,) for i in (3, 8, 1, 40)], "id BIGINT")
    neg = spark.createDataFrame([(i,) for i in (7, 2, 9)], "id BIGINT")
    pairs, unpaired = pair_by_position(pos, neg, "id")
    assert sorted((r["rank"], r.pos_id, r.neg_id) for r in pairs.collect()) == [(0, 1, 2), (1, 3, 7), (2, 8, 9)]
    assert [(r["rank"], r.pos_id) for r in unpaired.collect()] == [(3, 40)]


def test_pairs_of_paths(spark):
    """Paths in code point order over many partitions; a repeated path keeps its own positions."""
    names = [f"/clips/{'äz'[i % 2]}{i * 37 % 101}.wav" for i in range(101)] + ["/clips/z1.wav"] * 3
    pos = spark.createDataFrame([(p,) for p in names], "path STRING").repartition(5)
    neg = spark.createDataFrame([(f"/n/{i:03}.wav",) for i in range(60)], "path STRING")
    pairs, unpaired = pair_by_position(pos, neg, "path")
    order = sorted(names)
    assert sorted((r["rank"], r.pos_id, r.neg_id) for r in pairs.collect()) == [(i, order[i], f"/n/{i:03}.wav") for i in range(60)]
    assert sorted((r["rank"], r.pos_id) for r in unpaired.collect()) == list(enumerate(order))[60:]
    assert pair_by_position(pos.limit(0), neg, "path")[0].count() == 0


def test_balanced(spark):
    rows = [(i, "hot" if i % 3 else "rare") for i in range(90)]
    df = spark.createDataFrame(rows, "id BIGINT, label STRING")
    got = balanced(df, "label", "id", 12, slice_rows=7).groupBy("label").agg(F.max("id"), F.count("id")).collect()
    assert sorted(map(tuple, got)) == [("hot", 17, 12), ("rare", 33, 12)]


def greedy(clips, classes, n):
    """The selection by plain loops over (id, labels)."""
    count = {c: sum(c in labels for _, labels in clips) for c in classes}
    rarest = sorted((c for c in classes if count[c]), key=lambda c: (count[c], classes.index(c)))
    chosen, progress = {}, True
    while progress:
        short = {c: n - sum(v == c for v in chosen.values()) for c in rarest}
        wanted = [c for c in rarest if short[c]]
        homes = [(i, next((c for c in wanted if c in labels), None)) for i, labels in sorted(clips) if i not in chosen]
        taken = {i: c for c in wanted for i in [i for i, h in homes if h == c][: short[c]]}
        chosen |= taken
        progress = bool(taken)
    return chosen


@pytest.mark.parametrize("n", [3, 40])
def test_balanced_by_label(spark, n):
    """Clips of several labels, a hot one among them, chosen once; short classes are filled from what is left."""
    rng = np.random.default_rng(n)
    classes = ["b", "a", "hot", "d", "absent"]
    clips = [(int(i), [c for c, p in zip(classes + ["x"], (0.1, 0.1, 0.7, 0.3, 0, 0.5)) if rng.random() < p]) for i in rng.permutation(400)]
    df = spark.createDataFrame(clips + [(999, None)], "id BIGINT, labels ARRAY<STRING>").repartition(5)
    got = {r.id: r.label for r in balanced_by_label(df, F.col("labels"), "id", classes, n, slice_rows=16).collect()}
    assert got == greedy(clips, classes, n)
    assert balanced_by_label(df, F.col("labels"), "id", ["absent"], n).count() == 0
    sets = spark.createDataFrame([(1, ["Gunshot", "Speech"]), (2, ["Speech"]), (3, ["Music"])], "id BIGINT, labels ARRAY<STRING>")
    assert sorted(map(tuple, training_sets(sets, F.col("labels"), "id", 5, 5).collect())) == [(1, "Gunshot", True), (2, "Speech", False)]


def test_shuffled_ranks(spark):
    rows = spark.range(300).withColumn("v", F.col("id") * 2).repartition(7)
    got = {r.id: (r.rank, r.v) for r in shuffled_ranks(rows, 5, "id").collect()}
    order = [r.id for r in shuffle_rows(rows, 5, "id").collect()]
    assert got == {i: (k, 2 * i) for k, i in enumerate(order)}


def test_hot_clip_is_paired_in_parts(spark):
    pos = spark.range(5_000).select(F.lit(1).cast("bigint").alias("clip"), F.col("id").alias("example"))
    neg = spark.createDataFrame([(2, 0), (4, 0)], "clip BIGINT, example BIGINT")
    mixed = mixed_batches(pos, neg, "clip", seed=1)
    assert sorted(map(tuple, mixed.groupBy("batch_id", "clip", "labels").count().collect())) == [(0, 1, [1, 0], 5_000), (0, 2, [0, 1], 1)]
    keys = [line for line in mixed._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [clip" in line]
    assert keys and all("_salt" in line for line in keys)  # a clip is as many join keys as it has parts


def test_mixed_batches(spark):
    pos = spark.createDataFrame([(c, e) for c in (1, 3, 5) for e in range(2)], "clip BIGINT, example BIGINT")
    neg = spark.createDataFrame([(c, e) for c in (2, 4) for e in range(3)], "clip BIGINT, example BIGINT")
    mixed = mixed_batches(pos, neg, "clip", seed=1)
    got = sorted((r.batch_id, r.clip, r.example, tuple(r.labels)) for r in mixed.collect())
    assert got == [(b, c, e, y) for b in range(2) for c, n, y in ((2 * b + 1, 2, (1, 0)), (2 * b + 2, 3, (0, 1))) for e in range(n)]
    again = {(r.clip, r.example): r.batch_order for r in mixed_batches(pos, neg, "clip", seed=1).collect()}
    other = {(r.clip, r.example): r.batch_order for r in mixed_batches(pos, neg, "clip", seed=2).collect()}
    assert again == {(r.clip, r.example): r.batch_order for r in mixed.collect()} and again != other
