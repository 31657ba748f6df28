"""The pipeline's stages on awkward rows: nulls, empty and long texts, repeated rows, clashing names, and nothing."""

import pytest

import corpus_pipeline

EXTRA = "size long, kept string, score string, held_out string, row string, _row string, number string, ids string, times string"


@pytest.fixture()
def make(spark):
    names = [x.split()[0] for x in EXTRA.split(", ")]

    def build(rows):
        extra = [(i, *[f"{n}{i}" for n in names[1:]]) for i in range(len(rows))]
        return spark.createDataFrame([(*r, *e) for r, e in zip(rows, extra)], f"doc_id long, text string, lang string, source string, {EXTRA}").repartition(3)

    return build


def rows():
    en = "the quick brown fox jumps over the lazy dog and runs away from the very old house number "
    long_ = " ".join(f"word{'abcdefghij'[i % 10]} and the {'klmnopqrst'[i % 7]}ther" for i in range(30_000))
    out = [(i, en * 3 + "x" * (i + 1), "en", "a") for i in range(8)]
    out += [(None, en + "without an id", "en", "b"), (None, en + "without an id", "en", "b"), (20, None, "en", "a"), (21, "", "en", None)]
    out += [(22, " \t\n", None, "b"), (23, "12 34", "en", "a"), (24, long_, "en", None), (25, long_ + " end", "en", None), (26, "short one", None, "a")]
    return out + [(26, "short one", None, "a"), (26, "another text of this id", "en", "a"), (27, en + "only here", "en", "b")]


@pytest.mark.parametrize("at", range(5))
def test_stage(spark, make, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = make(rows())
    before = {r.size: r for r in docs.collect()}
    out = stage(spark, docs, "").collect()
    if name == "encode":
        assert len(out) == len(before) and all(r.round_trip for r in out)
        assert sorted(r.n_tokens for r in out)[:2] == [0, 0]
        return
    assert [f for f in out[0].__fields__] == docs.columns
    assert all(r == before[r.size] for r in out)  # whole rows, the clashing columns too
    kept = {r.size for r in out}
    texts = {i: r.text or "" for i, r in before.items()}
    if name == "language":
        assert kept == {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    elif name == "exact_dedup":
        assert len({texts[i] for i in kept}) == len(kept) == len(before) - 3
    elif name == "near_dedup":
        assert {i for i in range(8)} & kept == {0} and {14, 15} & kept == {14} and {10, 11, 12, 18, 19} <= kept
    else:
        assert not {10, 11, 12} & kept and max(sum(r.size == i for r in out) for i in kept) <= 2


@pytest.mark.parametrize("at", range(5))
def test_nothing(spark, make, at):
    docs = make(rows()).limit(0)
    out = corpus_pipeline.STAGES[at][1](spark, docs, "")
    assert out.count() == 0 and (at == 4 or out.columns == docs.columns)
