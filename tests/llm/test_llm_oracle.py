"""Registered corpus queries against SQL, and the pipeline's stages against plain code."""

import random
import re

import duckdb
import pytest

import corpus_pipeline
from acoustic_spark.llm import queries

SF = "/root/testdata/sf0.001"


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(tuple(str(v.item() if hasattr(v, "item") else v).removesuffix(".0") for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF).toPandas()
    assert len(found)
    if name in queries.SQL:
        con = duckdb.connect()
        for table in ("documents", "pages", "embeddings", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        expected = con.execute(queries.SQL[name]).df()
        assert sorted(found.columns) == sorted(expected.columns)
        assert rows(found) == rows(expected)


def test_secrets_like_their_sql(spark, tmp_path):
    """Values that tell the two apart if either has a rule of its own: very long ones, and ones without digits."""
    own, copied = "Ab1/" * 75, "Cd2+" * 100
    texts = [f"session {own} end", f"see {copied}", f"and {copied}", "password = CorrectHorseBattery", "password = ExampleExample", "secret: ExampleExample", "NoDigitsInThisBareTokenAtAll", None, "", "é token=abcdefghijkl0 AKIA" + "Z" * 40]
    spark.createDataFrame([(i, t, f"s{i % 7}" if i % 5 else None) for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op9_secret_ownership"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert rows(found) == rows(con.execute(queries.SQL["op9_secret_ownership"]).df())
    assert "live:8:308" in set(found["spans"]) and found["spans"].str.contains("live").sum() >= 3


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    language = corpus_pipeline.identify_language(spark, docs, SF)
    assert language.columns == columns and language.count() == docs.count()  # all have a language
    exact = corpus_pipeline.drop_copies(spark, docs, SF)
    first = {}
    for doc_id, text in sorted(docs.select("doc_id", "text").collect()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), doc_id)
    assert {r.doc_id for r in exact.collect()} == set(first.values())
    near = corpus_pipeline.drop_near_copies(spark, exact, SF)
    assert near.columns == columns and near.count() <= exact.count()
    mixed = corpus_pipeline.mix_sources(spark, near, SF)
    assert mixed.columns == columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in near.collect()}
    last = corpus_pipeline.run(spark, SF).collect()
    assert len(last) == mixed.count() and all(r.round_trip for r in last)


def near_groups(rows, n=5, percent=80):
    """Rows (doc_id, text) to the number of their group, by brute force over shingles of n words."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return group


def test_near_stage_takes_five_words_and_080(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([100, 100, 30, 250]))]
        rows.append(" ".join(base))
        for changes in (2, 3, 5):
            copy = list(base)
            for at in rng.sample(range(5, len(base) - 5), min(changes, len(base) // 40 + 1)):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    two = [f"v{i}" for i in range(100)]
    rows += [" ".join(two), " ".join("other" + w if i in (30, 70) else w for i, w in enumerate(two))]
    rows = list(enumerate(rows))
    group = near_groups(rows)
    expected = {min(i for (i, _), h in zip(rows, group) if h == g) for g in group}
    four = near_groups(rows, 4, 85)
    assert group[-1] == group[-2] and four[-1] != four[-2]  # 0.811 with 5 words, 0.848 with 4
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3)
    found = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert {r.doc_id for r in found.collect()} == expected
