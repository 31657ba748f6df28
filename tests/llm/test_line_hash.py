"""Line deduplication against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from acoustic_spark.llm import line_hash


def key_of(line):
    return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})


def brute(rows, least_chars=20, least_docs=3):
    holders, last = defaultdict(int), {}
    for doc_id, text in rows:
        for k in {key_of(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k] += 1
                order = (doc_id is not None, doc_id or 0)
                last[k] = max(last.get(k, order), order)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        order = (doc_id is not None, doc_id or 0)
        kept = [x for x in lines if holders[key_of(x)] < least_docs or last[key_of(x)] == order]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def same(found, expected):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def dropped(df):
    return line_hash.drop_repeated_lines(df).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()


def test_perfect_hash_places_each_hash_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 100, 70_000):
        hi, lo = (rng.integers(0, 1 << 63, n).astype(np.uint64) for _ in range(2))
        hi[: n // 2] = 7  # equal halves are still told apart by the other
        perfect = line_hash.PerfectHash.build(hi, lo)
        assert sorted(perfect.places(hi, lo)) == list(range(n))
        other = perfect.places(lo, hi)
        assert ((-1 <= other) & (other < max(n, 1))).all()


@pytest.mark.parametrize("probes", [1 << 18, 50])
def test_lines(docs, monkeypatch, probes):
    monkeypatch.setattr(line_hash, "PROBES", probes)  # many groups probe a shard's arrays
    monkeypatch.setattr(line_hash, "SHARD_KEYS", probes)
    rng = random.Random(2)
    pool = [f"line number {i} of the pool " + "x" * (i % 9) for i in range(60)] + ["short", "ÄÖÜ straße é 𝛼" * 2, "nineteen characters"]
    rows = []
    for i in range(200):
        lines = [rng.choice(pool) for _ in range(rng.randrange(8))]
        lines = [rng.choice([x, x.upper() if x.isascii() else x, f" \t{x}\r", f"{x} {i}"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    same(dropped(docs([(*r, None, None) for r in rows])), brute(rows))


def test_awkward(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    out = line_hash.drop_repeated_lines(awkward)
    assert set(awkward.columns) <= set(out.columns) and out.where("kept = 'z' and _h1 = 'x'").count() == len(rows)
    same(out.select("doc_id", "n_lines", "n_dropped", "kept_text").collect(), brute(rows))
    assert dropped(nothing) == []


def test_null_and_repeated_ids_and_hot_lines(docs):
    hot, other = "a line that every text has", "another line that many texts have"
    rows = [(i % 40, f"{hot}\n{hot}\nown {i} line of this text here") for i in range(120)]
    rows += [(None, f"{other}\nx{i}") for i in range(5)] + [(None, hot), (39, hot), (39, f"{hot}\n{other}"), (3, None), (3, "")]
    same(dropped(docs([(*r, None, None) for r in rows])), brute(rows))
    only = [(None, other)] * 4
    same(dropped(docs([(*r, None, None) for r in only])), brute(only))


def test_clashing_names(spark):
    rows = [(i, "the same line in all of the texts", 7, "a", "b") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, th string, _gone string")
    out = line_hash.drop_repeated_lines(df).collect()
    assert {(r.n_lines, r.th, r._gone) for r in out} == {(1, "a", "b")}
    assert sorted(r.n_dropped for r in out) == [0, 1, 1, 1]


def test_a_very_long_text_goes_in_slices(spark, monkeypatch):
    monkeypatch.setattr(line_hash, "SLICE", 64)
    text = "\n".join(f"line {i} of a very long text" for i in range(1000))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "th": [5, 6], "text": [text, text]})
    slices = list(line_hash._lines(20)(iter([batch])))
    assert max(s.num_rows for s in slices) <= 64 and sum(s.num_rows for s in slices) >= 1000
    assert sum(len(ids) for s in slices for ids in s["ids"]) == 2000
