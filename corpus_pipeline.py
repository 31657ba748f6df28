"""A corpus pipeline: language, exact copies, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but
the last give rows with the columns of documents. `run` writes each stage's rows as Parquet
to the shared folder and reads them for the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.llm import bpe, exact_dedup, jaccard, language, mixing
from acoustic_spark.llm.common import bound_batches, written
from acoustic_spark.workspace import ship_package

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Documents whose language has a smaller probability than this are rejected, as are those without letters.
MIN_SCORE = 0.4
#: Near copies have so many percent of their shingles of so many words in common, or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


#: Columns that the stages read; all others are carried along unread.
COLUMNS = ("doc_id", "text", "lang", "source")


def carrying(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with all columns that it doesn't read under names that no operator uses, and under their own again after it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        names = {c: f"carried_column_{i}" for i, c in enumerate(docs.columns) if c not in COLUMNS}
        done = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return done.withColumnsRenamed({v: k for k, v in names.items()})

    return run


@carrying
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language.

    Texts that are null, empty or without letters have none and go. Equal texts are all kept or all rejected, also with one
    id. A null id counts as held out from the statistics, a null lang too. An empty table gives an empty one.
    """
    known = language.identify_all(docs).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return known.select(*docs.columns)


@carrying
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of equal texts.

    A null text equals an empty one; null ids come last; of rows with one id and equal texts one stays. An
    empty table gives an empty one.
    """
    return exact_dedup.mark_copies(docs).where("kept").select(*docs.columns)


@carrying
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked documents: the smallest id, nulls last, and one row of a repeated id.

    Texts without words link with nothing and stay. An empty table gives an empty one.
    """
    row = "carried_row"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    dropped = jaccard.join_similar(numbered, n=NEAR_WORDS, percent=NEAR_PERCENT, number=row).where("not kept").select(F.col("number").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*docs.columns)


@carrying
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them, up to twice.

    Documents without words add nothing to a mix and are not taken. Rows that repeat an id are documents each; a
    null source is a source of its own. An empty table gives an empty one.
    """
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


@carrying
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether the ids decode to the text again.

    A null text is encoded as an empty one: no ids. Every row gives one, repeated ones too; an empty table gives none.
    The caller's job encodes, so from here on the session sends texts to Python in small batches.
    """
    bound_batches(spark)
    coded = bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the language model, the knapsack and the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
