"""Records with heads of any length."""

from acoustic_spark.llm import warc


def test_long_url_comes_back(spark):
    urls = {1: "http://a/" + "x" * 3_000_000, 2: "http://a/" + "é" * 400_000, 3: "u"}
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in urls.items()], "page_id long, url string, html string")
    out = {r["page_id"]: (r["url"], r["payload_bytes"]) for r in warc.round_trip(pages).collect()}
    assert out == {i: (warc.safe_url(u), 8) for i, u in urls.items()}
