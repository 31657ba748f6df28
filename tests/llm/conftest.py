import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    # Names that operators use themselves.
    T.StructField("_h1", T.StringType()), T.StructField("number", T.StringType()), T.StructField("kept", T.StringType()),
])


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text, lang, source), with columns whose names clash."""

    def make(rows):
        return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCS).repartition(3)

    return make


@pytest.fixture()
def awkward(docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long_ = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    passage = " ".join(f"p{i}" for i in range(80))
    return docs([
        (None, "no id " + passage, "en", "a"), (1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "b"),
        (4, "a", "en", "b"), (4, "a", "en", "b"), (5, long_, "en", "c"), (6, long_ + " end", "en", None),
        (7, "x " + passage, "fr", "a"), (8, "y " + passage, "fr", "a"), (8, "other text " + passage, "fr", "a"),
        (9, "aaaa" * 100, "de", "d"), (10, "token = 'AAbb11cc22dd33ee44ff'", "de", "d"), (11, "Straße 𝛼 é ü", "de", "d"),
    ])


@pytest.fixture()
def nothing(docs):
    return docs([])
