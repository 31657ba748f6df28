"""What the pipeline's steps make an executor hold: whole texts go to Python in batches bounded by bytes, not by rows alone."""

from collections import Counter

import pytest

import corpus_pipeline
from acoustic_spark.llm import common, jaccard, language
from acoustic_spark.llm.common import BATCH_BYTES, BATCH_SETTING

#: A batch may go beyond the bound by its last row.
LONGEST = 30_000


@pytest.fixture()
def texts(spark):
    """6 MB in one partition: one batch of Spark's own bounds."""
    rows = [(i, " ".join(f"w{'abcdefghij'[(i + j) % 10]}{'klmnopqrst'[j % 7]}x{i * j % 89}" for j in range(3_000)), "en", "a") for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


def largest(spark, seen):
    """Wraps a step's function of batches: `seen` counts, over all tasks, the bytes of text of batches beyond the bound."""

    def wrap(f):
        def run(batches):
            def each():
                for b in batches:
                    column = "text" if "text" in b else "packed" if "packed" in b else None
                    if column:
                        seen.add(int(sum(map(len, b[column])) > BATCH_BYTES + LONGEST))
                    yield b

            return f(each())

        return run

    return wrap


def test_language_sends_texts_in_small_batches(spark, texts, monkeypatch):
    over = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(language, "_count_words", largest(spark, over)(language._count_words))
    before = spark.conf.get(BATCH_SETTING)
    model = language.fit(texts)
    assert over.value == 0 and model.languages == ["en"] and spark.conf.get(BATCH_SETTING) == before
    assert language.identify(texts, model).where("lang_pred = 'en'").count() == 300


def test_near_copies_send_texts_in_small_batches(spark, texts, monkeypatch):
    over = spark.sparkContext.accumulator(0)
    wrap, prepared = largest(spark, over), jaccard._prepared
    monkeypatch.setattr(jaccard, "_count_words", wrap(jaccard._count_words))
    monkeypatch.setattr(jaccard, "_prepared", lambda *a: wrap(prepared(*a)))
    monkeypatch.setattr(jaccard, "_compressed", wrap(jaccard._compressed))
    before = spark.conf.get(BATCH_SETTING)
    assert jaccard.join_similar(texts).count() == 300
    assert over.value == 0 and spark.conf.get(BATCH_SETTING) == before


def test_the_session_keeps_a_smaller_bound_and_gets_its_own_back(spark):
    before = spark.conf.get(BATCH_SETTING)
    try:
        for own, within in (("64m", str(BATCH_BYTES)), ("70000000", str(BATCH_BYTES)), ("1000b", "1000b")):
            spark.conf.set(BATCH_SETTING, own)
            with pytest.raises(ZeroDivisionError), common.small_batches(spark):
                assert spark.conf.get(BATCH_SETTING).removesuffix("b") == within.removesuffix("b")
                raise ZeroDivisionError
            assert spark.conf.get(BATCH_SETTING) == own
    finally:
        spark.conf.set(BATCH_SETTING, before)


def test_encode_bounds_the_batches_of_the_callers_job(spark, texts):
    before = spark.conf.get(BATCH_SETTING)
    try:
        coded = corpus_pipeline.encode(spark, texts, "")
        assert int(spark.conf.get(BATCH_SETTING).removesuffix("b")) == BATCH_BYTES
        assert coded.where("round_trip").count() == 300
    finally:
        spark.conf.set(BATCH_SETTING, before)


def test_hashes_of_words_are_forgotten_without_a_change_of_the_sets(spark, texts, monkeypatch):
    few = texts.limit(40)
    want = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_similar(few).collect()}
    monkeypatch.setattr(jaccard, "KNOWN", 5)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_similar(few).collect()} == want


def test_counts_by_column(spark):
    held = {"en": Counter(a=2, b=1), "fr": Counter(), "de": Counter(a=7)}
    assert language._counted(held, "word").values.tolist() == [["en", "a", 2], ["en", "b", 1], ["de", "a", 7]]
    assert language._counted({}, "word").dtypes.tolist() == [object, object, int]  # Spark takes no empty frame of strings
    assert language._counted({}, "gram").columns.tolist() == ["lang", "gram", "n"]
