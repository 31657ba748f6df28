"""What the pipeline's steps make the driver hold: no broadcast a round of components, and little more than the items it keeps."""

import re

import pandas as pd
from pyspark.sql import functions as F

from acoustic_spark.llm import components as rounds, jaccard, language


def test_rounds_of_components_are_not_broadcast(spark, monkeypatch):
    plans, write = [], rounds.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(rounds, "written", seen)
    links = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(20, 21), (21, 22), (30, 30)], "a long, b long")
    found = {r["node"]: r["component"] for r in rounds.components(links).collect()}
    assert found == {i: 0 for i in range(7)} | {20: 20, 21: 20, 22: 20}
    assert any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "BroadcastExchange" in p]


def test_tasks_sort_few_items_more_than_are_kept(spark):
    rows = [(f"w{i:04d}", 1 + 20_000 // (i + 1)) for i in range(3_000)] + [(f"t{i:04d}", 1) for i in range(500)]
    table = spark.createDataFrame(rows, "item string, all long").repartition(8)
    tally = language._tally(table)
    assert sum(tally.values()) == len(rows)
    for n in (1, 40, 300, 2_999, 3_200, 5_000):
        want = [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n]]
        assert [r["item"] for r in language._most_frequent(table, n, tally).collect()] == want
    plan = language._most_frequent(table, 40, tally)._jdf.queryExecution().optimizedPlan().toString()
    least = int(re.search(r"all#\d+L >= (\d+)\)", plan)[1])
    assert 40 <= table.where(F.col("all") >= least).count() < 100


def test_most_frequent_of_powers_of_two_and_of_nothing(spark):
    rows = [(f"p{d:02d}", 1 << d) for d in range(62)] + [(f"q{d:02d}", (1 << d) - 1) for d in range(1, 62)]
    table = spark.createDataFrame(rows, "item string, all long")
    tally = language._tally(table)
    for n in range(1, len(rows) + 2, 7):
        want = [w for w, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:n]]
        assert [r["item"] for r in language._most_frequent(table, n, tally).collect()] == want
    empty = table.where("false")
    assert language._tally(empty) == {} and language._most_frequent(empty, 5, {}).count() == 0


def test_levels_reach_the_driver_compressed(spark):
    texts = spark.createDataFrame([("a b c " * 100,), ("a d",), ("",)], "text string")
    levels = jaccard.word_levels(texts)
    assert len(levels) == jaccard.BUCKETS and sorted(x for x in levels if x) == [6, 6, 6]  # a, b and c; once is level 0
    rows = jaccard._level_range(pd.DataFrame({"bucket": [5], "n": [70]}))
    assert len(rows["levels"][0]) < jaccard.RANGE // 10
