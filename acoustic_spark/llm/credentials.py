"""Secret scan by corpus-wide ownership frequency, DataFrame functions only.

Patterns with a clear form give the base spans. Their values, and bare tokens that only
look random, are candidates: how many repositories and owners have the same value in the
whole corpus tells widely copied examples from values that one owner alone has. The
latter look live and get a span of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.llm.common import join_counted, text_or_empty, written


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Names before an assigned secret, and what a secret consists of.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
#: kind -> (pattern, characters at least, group that has them). Order: as in spans that start together.
BASE = {
    "assign": ("(" + "|".join(_any_case(n) for n in NAMES) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    "access": (r"AKIA[A-Z0-9]{14,}", 18, 0),
    "hex": (r"[0-9a-f]{16,}", 16, 0),
}
#: A bare candidate: a run of so many of these characters or more with a lower case letter, an upper case letter and a digit.
BARE, BARE_LEAST = r"[A-Za-z0-9+/_-]{20,}", 20
KINDS = (*BASE, "live")

#: A value is owner-specific up to so many owners and repositories; beyond, it is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 1, 5

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"


def matches(text: Column, pattern: str, kind: str, group: int, least: int) -> Column:
    """All leftmost non-overlapping matches with their places in code points.

    The pieces between matches and the matches themselves give the places: a match starts
    after all pieces and matches before it. Matches whose group is shorter than `least` drop out.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    wanted = F.regexp_extract_all(text, F.lit(pattern), group) if group else found
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.zip_with(F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("gap"), m.alias("all"))), wanted, lambda x, w: F.struct(x["gap"].alias("gap"), x["all"].alias("all"), w.alias("own")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, m: Column) -> Column:
        begin = acc["at"] + m["gap"]
        end = begin + F.coalesce(F.length(m["all"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), m["own"].alias("value"))
        more = F.when(F.length(m["own"]) >= least, F.concat(acc["spans"], F.array(span).cast(SPAN))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    spans = F.aggregate(zipped, start, step, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, base_spans, all_spans (arrays of spans), n_shared (candidates that are copied examples).

    A document is a repository, its source the owner. Candidates are the values of base
    spans and bare random-looking tokens of any length outside them; one that at most
    MAX_OWNERS owners and MAX_REPOSITORIES documents have in the whole corpus gets a span of
    kind live. A null text counts as empty; null sources are one owner, rows of one doc_id
    one repository. Rows that repeat doc_id and text get equal results. An empty table gives
    an empty result; other columns are not read.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(owner).cast("string").alias("owner"), text_or_empty(text).alias("text"))
    base = base.withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("h")))
    base = base.withColumn("base_spans", F.concat(*[matches(F.col("text"), p, k, g, n) for k, (p, n, g) in BASE.items()]))
    bare = matches(F.col("text"), BARE, "live", 0, BARE_LEAST)
    bare = F.filter(bare, lambda b: b["value"].rlike("[a-z]") & b["value"].rlike("[A-Z]") & b["value"].rlike("[0-9]"))
    clear = F.filter(bare, lambda b: ~F.exists(F.col("base_spans"), lambda s: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    live = F.transform(F.concat("base_spans", clear), lambda s: F.struct(
        (s["end"] - F.length(s["value"])).alias("start"), F.lit(KINDS.index("live")).alias("rank"), s["end"].alias("end"), F.lit("live").alias("kind"), F.sha2(s["value"], 256).alias("value"),
    ))
    found = written(base.withColumn("candidates", F.array_distinct(live)).drop("text"), "candidates")

    each = found.select("key", "owner", F.explode("candidates").alias("span")).withColumn("value", F.col("span.value"))
    # Copies of a value within an owner meet first, so a value that everybody has stays small.
    of_owner = each.groupBy("value", "owner", "key.doc_id").agg(F.count(F.lit(1)).alias("n"))
    of_owner = of_owner.groupBy("value", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repositories"))
    owners = of_owner.groupBy("value").agg(F.sum("n").alias("n"), F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    total = found.agg(F.sum(F.size("candidates"))).first()[0] or 0
    judged = join_counted(each, owners, "value", "n", total)
    own = (F.col("owners") <= MAX_OWNERS) & (F.col("repositories") <= MAX_REPOSITORIES)
    added = judged.groupBy("key").agg(F.collect_set(F.when(own, F.col("span"))).alias("added"), F.count(F.when(~own, 1)).alias("n_shared"))

    out = found.join(added, "key", "left")
    every = F.concat("base_spans", F.coalesce("added", F.array().cast(SPAN)))
    return out.select("key.doc_id", "base_spans", every.alias("all_spans"), F.coalesce("n_shared", F.lit(0)).alias("n_shared"))
