"""The registered queries of the operators, one each, with SQL equivalents where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.llm import bpe, credentials, exact_dedup, html_template, jaccard, language, line_hash, mixing, prefix_trie, repeats, topk, warc, whitening
from acoustic_spark.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def add(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_template")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_OP2 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
),
n AS (
  SELECT *, list_transform(range(0, 8), lambda i: ('0x' || hex[5 * i + 1 : 5 * i + 5])::BIGINT) AS groups, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(groups, lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('{_ALPHABET}', ((g >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM n
"""


@query("op2_warc_normaliser", _OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_language_backoff")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify_all(docs).select("doc_id", "held_out", "lang_pred", "score")


def token_digests(coded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of ids and decoded."""
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(joined, 256), "decoded_sha256": F.sha2("decoded", 256)})


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return token_digests(coded).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


_OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))) END AS shingles FROM w
),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * c.c >= 85 * (x.n + y.n - c.c)),
g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a, b FROM g UNION SELECT r.a, g.b FROM r JOIN g ON r.b = g.a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id FROM n LEFT JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""


@query("op5_jaccard_join", _OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"), n=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query("op6_mix_budget")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


_OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op7_topk_segments", _OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


_OP8 = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256 FROM t
"""


@query("op8_bloom_dedup", _OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _matches_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, text_h, g[i] AS value,
    list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1 : i - 1]), 0) AS s, list_sum(gaps[1:i]) + list_sum(sizes[1:i]) AS e
  FROM (
    SELECT *, unnest(range(1, len(g) + 1)) AS i FROM (
      SELECT doc_id, source, md5(text) AS text_h, regexp_extract_all(text, '{pattern}', {group}) AS g,
        list_transform(regexp_extract_all(text, '{pattern}'), lambda x: length(x)) AS sizes,
        list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x)) AS gaps
      FROM d
    )
  ) WHERE length(g[i]) >= {least}"""


_BASE_SQL = " UNION ALL ".join(_matches_sql(k, i, p, g, n) for i, (k, (p, n, g)) in enumerate(credentials.BASE.items()))
_OP9 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({_BASE_SQL}),
bare AS (
  SELECT * FROM ({_matches_sql("live", 3, credentials.BARE, 0, credentials.BARE_LEAST)}) x
  WHERE regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.s < x.e AND x.s < b.e)
),
cand AS (
  SELECT DISTINCT doc_id, source, 'live' AS kind, 3 AS rank, e - length(value) AS s, e, value
  FROM (SELECT * FROM base UNION ALL SELECT * FROM bare)
),
own AS (
  SELECT value FROM cand GROUP BY value
  HAVING count(DISTINCT coalesce('s' || source, 'n')) <= {credentials.MAX_OWNERS} AND count(DISTINCT doc_id) <= {credentials.MAX_REPOSITORIES}
),
spans AS (
  SELECT doc_id, kind, rank, s, e FROM base
  UNION ALL SELECT doc_id, kind, rank, s, e FROM cand WHERE value IN (SELECT value FROM own)
),
j AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j ON j.doc_id = d.doc_id
"""


@query("op9_secret_ownership", _OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials.scan(table(spark, sf_dir, "documents"))
    counts = [credentials.number_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in credentials.BASE]
    base = F.sha2(credentials.joined(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, credentials.joined(F.col("all_spans")).alias("spans"))


@query("op10_suffix_radix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), "kept_sha256")


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return done.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


_OP12 = rf"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
),
e AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l
),
k AS (
  SELECT line_key, max(doc_id) AS last FROM e WHERE length(line_key) >= {line_hash.LEAST_CHARS}
  GROUP BY line_key HAVING count(DISTINCT doc_id) >= {line_hash.LEAST_DOCS}
),
f AS (SELECT e.*, k.last IS NOT NULL AND e.doc_id <> k.last AS gone FROM e LEFT JOIN k ON k.line_key = e.line_key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""


@query("op12_line_hash", _OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_hash.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_OP13 = f"""
WITH crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS r
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
  SELECT conv_id, conv_id - conv_id % {prefix_trie.FAMILY} AS family, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {prefix_trie.HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc
),
turns AS (
  SELECT c.conv_id, r, role, text FROM c JOIN own ON own.conv_id = c.family AND r < h
  UNION ALL SELECT c.conv_id, r, role, text FROM c JOIN own ON own.conv_id = c.conv_id AND r >= h
),
seq AS (
  SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY r) FILTER (r IS NOT NULL) AS k, list(length(text) ORDER BY r) AS n
  FROM c LEFT JOIN turns USING (conv_id) GROUP BY conv_id
),
m AS (
  SELECT conv_id, d, k[1:d] AS p, d = len(k) AS ends, CASE WHEN d > 0 THEN n[d] ELSE 0 END AS chars
  FROM (SELECT conv_id, coalesce(k, []) AS k, n, unnest(range(0, coalesce(len(k), 0) + 1)) AS d FROM seq)
),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY p, d
),
kids AS (SELECT p[1 : d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT p[1:a] AS p, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
  FROM (SELECT node.*, n_children, unnest(range(0, d + 1)) AS a FROM node LEFT JOIN kids USING (p)) GROUP BY ALL
)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.p = node.p LEFT JOIN kids ON kids.p = node.p LEFT JOIN node up ON node.d > 0 AND up.p = node.p[1 : node.d - 1]
"""


@query("op13_prefix_trie", _OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))
