"""Query ids that repeat with other vectors."""

import pytest

from acoustic_spark.llm import topk


@pytest.mark.parametrize("block", [1, 16384])
def test_every_vector_of_an_id_is_a_query(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (0, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 5.0]), (3, [1.0, 1.0]), (50, [-1.0, 0.0])]
    out = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3).collect()
    found = {q: [(r["vec_id"], r["score"] >> 16) for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50)}
    assert found == {0: [(2, 5), (1, 3), (3, 1)], 50: [(0, 0), (2, 0), (3, -1)]}
