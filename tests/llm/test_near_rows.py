"""The near_dedup stage keeps one row a group where ids repeat or are missing."""

from pyspark.sql import functions as F

import corpus_pipeline
from acoustic_spark.llm import jaccard


def test_one_row_of_each_group(spark):
    first, second, third, clean = (" ".join(f"{c}{i}" for i in range(100)) for c in "abcd")
    rows = [(1, first), (2, first + " end"), (2, clean), (3, second), (3, second + " end"), (None, third), (None, third + " end"), (4, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3)
    left = [(r.doc_id, (r.text or "").removesuffix(" end")) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(left, key=str) == sorted([(1, first), (2, clean), (3, second), (None, third), (4, ""), (None, "")], key=str)


def test_rows_of_members_come_through_unmoved(spark):
    """The bitmap keeps every member, drops nearly all other rows and shuffles none of them."""
    rows = spark.range(-20_000, 60_000).select(F.col("id").alias("number"), F.lit("x").alias("text"))
    members = spark.range(-20_000, 60_000, 40).select(F.col("id").alias("number"))
    found = jaccard.maybe_among(rows, members, 2_000)
    numbers = {r.number for r in found.collect()}
    assert found.columns == ["number", "text"] and set(range(-20_000, 60_000, 40)) <= numbers and len(numbers) < 2_000 + 4_000
    assert jaccard.maybe_among(rows, members.limit(0), 0).count() == 0
