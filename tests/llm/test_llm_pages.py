"""Page, archive and vector operators."""

import base64
import gzip
import hashlib
import io
import json

import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from acoustic_spark.llm import html_template, topk, warc

PAGE = "page_id long, url string, html string, slot string"


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_main_text(spark):
    shell = "<nav><ul><li><a href='/'>menu</a></li></ul></nav><div class='cookie-notice'>notice</div>{}<aside>side</aside><footer>&copy; foot</footer>"
    texts = ["<article><header>head</header><h1>A &amp; B</h1><p><b>one\n  two<br><p>three<script>var x='</p>';</script> four</p><form>f</form><section class='comments'><p>reader</p></section><p>x &lt; y</p></article>"] * 3
    rows = [(i, f"http://h.example/{i}", page(shell.format(t)), "x") for i, t in enumerate(texts)]
    rows += [(7, "http://h.example/7", page("<main><p>own</p><div class='ad'>buy</div></main>"), None), (8, None, None, None), (9, "http://h.example/9", "", None), (9, "http://h.example/9", "", None)]
    rows += [(10, "http://i.example", "plain text, no <b>tags", None), (11, "http://j.example", page("<div class='content'><p>a<p>b</div><div class='sidebar'>s</div>"), None)]
    out = {r["page_id"]: r for r in html_template.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert out[0]["text"] == out[2]["text"] == "A & B\none two\nthree four\nx < y"
    assert out[7]["text"] == "own" and out[8]["text"] == out[9]["text"] == ""
    assert out[10]["text"] == "plain text, no tags" and out[11]["text"] == "a\nb"
    assert all(r["n_chars"] == len(r["text"]) for r in out.values()) and out[0]["slot"] == "x"
    assert html_template.extract(spark.createDataFrame([], PAGE)).count() == 0


def tokens_of(spark, rows):
    return spark.createDataFrame([(h, p, 0, t, n, s, 0, 0, 0, False, 1, 1) for h, t, p, n, s in rows], f"host string, page long, {html_template.TOKENS}")


def test_vectors_make_classes(spark):
    rows = [("h", t, p, n, n == 1) for t, n in ((1, 1), (2, 1), (3, 2)) for p in range(4)] + [("h", 4, p, 1, True) for p in (0, 1)] + [("h", 5, p, 1, True) for p in (1, 2)] + [("h", 6, 0, 1, True)]
    found = html_template.vectors(tokens_of(spark, rows)).withColumn("n", F.lit(4))
    made = sorted((r["support"], sorted(p["token"] for p in r["parts"])) for r in html_template.classes(found).collect())
    assert made == [(2, [4]), (2, [5]), (4, [1, 2])]  # not single, or of too few pages: no class


def brute_template(pages):
    """Frame and template runs of a host's pages by whole occurrence vectors."""
    tokens = [{t[1]: t for t in html_template.page_tokens(p)} for p in pages]
    vectors = {}
    for t in set().union(*tokens):
        vectors[t] = tuple(page[t][2] if t in page else 0 for page in tokens)
    groups = {}
    for t, v in vectors.items():
        single = all(page[t][3] for page in tokens if t in page)
        if single and 2 * sum(map(bool, v)) >= len(pages):
            groups.setdefault(v, []).append(t)
    kind = {t: row[0] for page in tokens for t, row in page.items()}
    return {t for g in groups.values() for t in g if kind[t] == 1 and len({pages[i] for i, n in enumerate(vectors[t]) if n}) > 1 and sum(kind[x] == 0 for x in g) > 1}


def test_template_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    say = lambda k: " ".join(f"w{x}" for x in rng.integers(0, 500, k))
    hosts = {}
    for host in ("a.example", "b.example", "c.example"):
        menu, foot, line = say(4), say(6), say(12)
        hosts[host] = [
            page(f"<div class=c1><ul><li>{menu}</ul></div>" + (f"<div class=c9><i>{foot}</i><div>{menu}</div></div>" if i % 3 else "") + f"<div class=c2><h1>{say(3)}</h1><p>{say(40)}<p>{line}<p>{say(40)}</div><div class=c3>{foot}</div>")
            for i in range(9)
        ]
    rows = [(i, f"http://{h}/{i}", p, None) for h, pages in hosts.items() for i, p in enumerate(pages)]
    table = spark.createDataFrame(rows, PAGE).select(html_template.host_of("url").alias("host"), F.xxhash64("html").alias("page"), "html")
    sizes = table.groupBy("host").agg(F.count("*").alias("n"))
    found = {r["host"]: r for r in html_template.templates(html_template.occurrences(table), sizes, 27).collect()}
    for host, pages in hosts.items():
        assert set(found[host]["runs"]) == brute_template(pages) and len(found[host]["runs"]) >= 4


def test_neutral_names_and_repeated_text(spark):
    """Menu, footer and a line that all articles repeat go though no name tells; words only decide what they can."""
    words = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    rows, expected = [], {}

    def add(host, i, body, text):
        rows.append((len(rows), f"http://{host}/{i}", page(body), None))
        expected[len(rows) - 1] = text

    for i in range(20):
        a, b = words(i, 30), words(i + 100, 20)
        add("neutral", i, f"<div class='c1'><a>home</a><a>news</a></div><div class='c2'><h2>t{i}</h2><p>{a}</p><p>read us daily</p><p>{b}</p></div><div class='c3'>all rights reserved</div>", f"t{i}\n{a}\n{b}")
        add("layout", i, f"<div class='page sidebar-layout'><div class=sidebar>side {i}</div><article><p>{a}</p></article></div>", a)
        add("wrapped", i, f"<div class='sidebar'><div class=x><p>{a}</p><p>{b}</p></div></div><footer>f</footer>", f"{a}\n{b}")
        add("inside", i, f"<article><p>{a}</p><div class='share-price'>price {i}</div><section class='post notice'>{b}</section><div class='comment-list'>me {i}</div><div class=ad-slot>buy {i}</div></article>", f"{a}\nprice {i}\n{b}")
        add("copies", i, f"<nav>n</nav><article><p>one article that every page has</p></article><footer>{i}</footer>", "one article that every page has")
        add("id", i, f"<div id='post-{i}'><p>{a}</p></div><div class=menu>m</div>", a)
    out = {r["page_id"]: r["text"] for r in html_template.extract(spark.createDataFrame(rows, PAGE).repartition(5)).collect()}
    assert out == expected


def test_deep_long_and_clashing_pages(spark):
    deep = "<div class=c1>" * 20_000 + "<p>deep</p>"
    long_ = page("<article>" + "<p>word &amp; word</p>" * 50_000 + "</article>")
    schema = "page_id long, url string, html string, text string, n_chars string, _host int, slot string, runs int, n int, host string"
    rows = [(i, u, h, "old", "x", 1, "s", 2, 3, "h") for i, u, h in ((1, "http://d/1", deep), (2, "http://l/2", long_), (2, "http://l/2", long_), (None, None, "<p>x"), (4, "http://l/4", None))]
    out = html_template.extract(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "url", "html", "_host", "slot", "runs", "n", "host", "text", "n_chars"]
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"], r["slot"], r["host"]) for r in out.collect())
    lines = "\n".join(["word & word"] * 50_000)
    assert got == [(0, "x", 1, "s", "h"), (1, "deep", 4, "s", "h"), (2, lines, len(lines), "s", "h"), (2, lines, len(lines), "s", "h"), (4, "", 0, "s", "h")]


def test_warc(spark):
    rows = [(5, "http://a/é x", "<p>é</p>", "s"), (3, None, "<p>é</p>", "s"), (None, "u", "<p>é</p>", "s"), (4, "u", None, "s"), (6, "u", "", "s"), (7, "u\r\nX: y", "z" * 3_000_000, "s"), (7, "u", "z" * 3_000_000, "s")]
    out = warc.round_trip(spark.createDataFrame(rows, PAGE)).collect()
    assert len(out) == len(rows)
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    found = sorted((r["page_id"] or 0, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out if r["page_id"] != 7)
    expected = [(0, 9, digest("<p>é</p>"), "revisit", 3), (3, 9, digest("<p>é</p>"), "response", None), (4, 0, digest(""), "response", None), (5, 9, digest("<p>é</p>"), "revisit", 3), (6, 0, digest(""), "revisit", 4)]
    assert found == expected
    assert sorted(r["record_type"] for r in out if r["page_id"] == 7) == ["response", "revisit"]
    assert warc.round_trip(spark.createDataFrame([], PAGE)).count() == 0


def test_normaliser_writes_members(tmp_path):
    """A monolithic archive, and one that is partly in members, end as one member a record, found by the index."""
    records = [warc.info_record("d")] + [warc.record(i, f"u{i}", b"x" * i, hashlib.sha1(b"x" * i).hexdigest(), "response", None, "d") for i in (0, 1, 5_000_000)]
    for data in (gzip.compress(b"".join(records)), gzip.compress(records[0] + records[1]) + gzip.compress(records[2] + records[3])):
        path = tmp_path / f"{hashlib.sha1(data).hexdigest()}.warc.gz"
        path.write_bytes(data)
        name, index, n = warc.normalise_archive(pafs.LocalFileSystem(), str(path))
        whole = open(name, "rb").read()


        entries = [json.loads(line) for line in open(index)]
        assert n == 4 and [gzip.decompress(whole[e["offset"] : e["offset"] + e["length"]]) for e in entries] == records
        assert gzip.GzipFile(fileobj=io.BytesIO(whole)).read() == b"".join(records)
    path.write_bytes(data[:-20])
    with pytest.raises(ValueError):
        warc.normalise_archive(pafs.LocalFileSystem(), str(path))


VECTORS = "vec_id long, embedding array<float>, label int"


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).astype(float).tolist(), 1) for i in range(300)]
    rows += [(300, rows[0][1], 1), (301, None, 1), (302, [None] * 24, 1), (303, [float("nan")] * 24, 1), (304, [], 1), (350, [1.0, 2.0], 1), (351, [3.0, -4.0], 1), (None, rows[1][1], 1), (5, rows[5][1], 1)]
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(spark.createDataFrame(rows, VECTORS).repartition(3)).collect())
    valid = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v, _ in rows if i is not None and v and not any(x is None or x != x for x in v)}
    expected = []
    for q in (i for i in valid if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items() if i != q and len(v) == len(valid[q]))
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert out == sorted(expected)
    assert topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 64)) * 300
    x = (centre[rng.integers(0, 6, 4000)] + rng.normal(size=(4000, 64)) * 20).astype(np.int64)
    for segments in topk.RESOLUTIONS:
        m, d = topk.segment_statistics(x[:50].astype(float), segments)
        assert (m @ m.T + d @ d.T + 1e-3 >= x[:50] @ x[:50].T).all()
    searcher = topk.Searcher(np.arange(20), x[:20], 5)
    for i in range(0, 4000, 500):
        searcher.add(np.arange(i, i + 500), x[i : i + 500])
    assert searcher.compared < searcher.pairs
    best = searcher.rows().groupby("query_id")["score"].max()
    assert all(best[q] == max(int(x[q] @ x[j]) for j in range(4000) if j != q) for q in range(20))


def test_large_components_are_exact():
    q, x = np.array([[1 << 25, -3]]), np.array([[1 << 25, 5], [7, 1 << 40]])
    assert topk.exact_products(q, x).tolist() == [[(1 << 50) - 15, (7 << 25) - (3 << 40)]]
