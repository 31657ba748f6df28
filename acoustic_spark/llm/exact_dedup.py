"""Exact deduplication by a two-pass Bloom filter, DataFrame functions only.

Pass one counts the slots of a Bloom filter and keeps those that two or more rows set.
Pass two flags the rows whose slots are all among them. Only flagged rows are shuffled
to meet their equals; the rest pass straight through, each the only one of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import SPACE, fresh, join_counted, maybe_repeated, repeat_filter, text_or_empty, written


def mark_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after each run of ASCII white space has become one
    space; a null text counts as empty. Of equal texts the row with the smallest doc_id is
    kept. Rows that repeat a doc_id with equal texts count each, and one of them is kept;
    a null doc_id comes after all others, and is kept (keep_id null) where no other is.
    An empty table gives an empty result. Result columns replace input columns of the
    same name; all others, whatever their names, stay as they are.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    docs = docs.drop(*added) if text not in added and doc_id not in added else docs
    h1, h2, row, order, flag, best = fresh(docs, "h1", "h2", "row", "order", "flag", "best")
    # Written once: texts are hashed a single time, and a row keeps its number whatever is lost later.
    hashed = docs.withColumn("text_sha256", F.sha2(F.regexp_replace(text_or_empty(text), SPACE, " "), 256))
    hashed = written(hashed.withColumn(row, F.monotonically_increasing_id()), "hashed")
    hashed = hashed.withColumns({h1: F.xxhash64("text_sha256"), h2: F.xxhash64(F.lit(1), "text_sha256")})
    n_rows = hashed.count()
    bitmaps = written(repeat_filter(hashed.select(h1, h2), [h1, h2], n_rows), "bitmaps")
    flagged = maybe_repeated(hashed, bitmaps, [h1, h2], n_rows, flag).drop(h1, h2)

    single = flagged.where(~F.col(flag)).drop(flag, row)
    single = single.withColumns({"keep_id": F.col(doc_id), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})

    many = flagged.where(F.col(flag)).drop(flag)
    many = many.withColumn(order, F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), F.col(row).alias("row"))).drop(row)
    groups = many.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias(best))
    joined = join_counted(many, groups, "text_sha256", "group_size", n_rows)
    joined = joined.withColumns({"keep_id": F.col(f"{best}.id"), "kept": F.col(order) == F.col(best)}).drop(order, best)
    return single.unionByName(joined.select(single.columns))
