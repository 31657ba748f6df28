"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length. Whole passes of a source use up most of its
target; the remaining budget is fitted on the length counts: an even share of every
length first, then a bounded knapsack by dynamic programming for what is left. Which
documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustic_spark.llm.common import WORD, fresh, text_or_empty, written

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)
SHARE, LIMIT = 1.5, 2

#: Words that the knapsack still has to fit at most; even shares and large steps bring the budget below it.
KNAPSACK_WORDS = 1 << 16
#: Hash ranges within one (source, length): rows are ranked inside a range only.
RANGES = 1024


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> list[float]:
    """Target words of each source, the sources given in order.

    A target stops at `limit` times its source's size; the excess goes to the others by
    weight until none is above. Sources without words get 0.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    cap = [float(limit * s) for _, s in sizes]
    out = [0.0] * len(sizes)
    open_, left = [i for i, c in enumerate(cap) if c > 0], share * sum(s for _, s in sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        above = [i for i in open_ if left * weight[i] / total > cap[i]]
        if not above:
            for i in open_:
                out[i] = left * weight[i] / total
            break
        for i in above:
            out[i] = cap[i]
        left -= sum(cap[i] for i in above)
        open_ = [i for i in open_ if i not in above]
    return out


def fit_budget(counts: list[tuple[int, int]], budget: int, knapsack_words: int = KNAPSACK_WORDS) -> list[int]:
    """How many documents of each length to take so that their words come near to `budget`, not above it.

    `counts` has (length, documents). First every length gives the same share, rounded
    down; then single documents, longest first, while the rest is over `knapsack_words`;
    then a bounded knapsack over the documents left comes as near as these can. Other shares might come
    some words nearer.
    """
    total = sum(length * n for length, n in counts)
    if total <= budget:
        return [n for _, n in counts]
    share = budget / total if total else 0.0
    taken = [int(n * share) if length else 0 for length, n in counts]
    left = budget - sum(length * t for (length, _), t in zip(counts, taken))
    while left < 0:  # rounding of the share
        i = max(k for k, t in enumerate(taken) if t)
        taken[i] -= 1
        left += counts[i][0]
    for i in sorted(range(len(counts)), key=lambda k: -counts[k][0]):
        length, n = counts[i]
        if length and left > knapsack_words:
            more = min(n - taken[i], (left - knapsack_words) // length)
            taken[i] += more
            left -= more * length
    # Reachable sums as bits of an integer; a length with m documents left counts as 1, 2, 4, ... of them.
    items = []
    for i, (length, n) in enumerate(counts):
        m, step = n - taken[i], 1
        m = min(m, left // length) if 0 < length <= left else 0
        while m > 0:
            items.append((i, min(step, m)))
            m -= step
            step *= 2
    mask = (1 << (left + 1)) - 1
    reach = [1]
    for i, k in items:
        reach.append((reach[-1] | reach[-1] << (k * counts[i][0])) & mask)
        if reach[-1] >> left & 1:
            break
    at = reach[-1].bit_length() - 1
    for j in range(len(reach) - 1, 0, -1):
        if not reach[j - 1] >> at & 1:
            i, k = items[j - 1]
            taken[i] += k
            at -= k * counts[i][0]
    return taken


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """The plan of one source from its lengths: whole passes and documents of each length for one more."""
    pdf = pdf.sort_values("length")
    target, size = float(pdf["target"].iloc[0]), int((pdf["length"] * pdf["n"]).sum())
    passes = int(target // size) if size else 0
    counts = list(zip(pdf["length"].tolist(), pdf["n"].tolist()))
    extra = fit_budget(counts, round(target - passes * size)) if size and target > passes * size else [0] * len(counts)
    return pdf.assign(passes=passes, extra=[e if length else 0 for (length, _), e in zip(counts, extra)])[["source_key", "length", "n", "source_size", "target", "passes", "extra"]]


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = 1) -> DataFrame:
    """`docs` with size (words), source_size, target and times (how often the mix takes the row, 0 to 2).

    Sources in code point order, null last, weigh 3, 1, 2, repeating, and share 150 % of
    all words; no target is above twice its source's words. A null text has no words; rows
    without words are not taken. Rows that repeat a doc_id count each. Reruns agree: a row's place is that of its
    id's hash, of its text's where the id is null, and rows that share both are taken alike. An
    empty table gives an empty result. Result columns replace input columns of the same name.

    The lengths of a source, not its rows, meet in one task: there are at most about
    sqrt(2 * words) different lengths. The sources' sizes reach the driver, one row each.
    """
    docs = docs.drop(*[c for c in ("size", "source_size", "target", "times") if c not in (text, source, doc_id)])
    key, rank, part, before, passes, order, tie = fresh(docs, "source_key", "rank", "part", "before", "passes", "order", "tie")
    # A key that is never null and sorts by code point with null last.
    named = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))
    sized = docs.withColumns({"size": word_count(text), key: named})
    # The rank of a row within (source, length) by seeded hash is its rank in a hash range plus
    # the rows of the ranges before. A range is taken whole, not at all or, one range a length, in
    # part: `quota` of its rows. Ranges keep a hot length from one task.
    sized = sized.withColumn(tie, F.xxhash64(text_or_empty(text)))
    sized = sized.withColumn(order, F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit(seed), tie)).otherwise(F.xxhash64(F.lit(seed), F.col(doc_id))))
    keys = [key, "size", part]
    ranged = sized.withColumn(part, F.pmod(F.shiftright(order, 40), F.lit(RANGES)).cast("int"))
    counted = written(ranged.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_range")), "lengths")
    lengths = counted.groupBy(F.col(key).alias("source_key"), F.col("size").alias("length")).agg(F.sum("in_range").alias("n"))

    totals = lengths.groupBy("source_key").agg(F.sum(F.col("length") * F.col("n")).alias("source_size")).collect()
    totals = sorted([(r[0], int(r[1])) for r in totals], key=lambda r: r[0].encode("utf-8"))
    goal = docs.sparkSession.createDataFrame(
        [(k, s, t) for (k, s), t in zip(totals, targets(totals))], "source_key string, source_size long, target double"
    )
    plan = lengths.join(goal, "source_key").groupBy("source_key").applyInPandas(
        _plan, "source_key string, length long, n long, source_size long, target double, passes int, extra long"
    )

    earlier = Window.partitionBy(key, "size").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.select(F.col("source_key").alias(key), F.col("length").alias("size"), "source_size", "target", "passes", "extra")
    counted = counted.withColumn(before, F.coalesce(F.sum("in_range").over(earlier), F.lit(0))).join(plan, [key, "size"])
    quota = F.greatest(F.lit(0), F.least(F.col("extra") - F.col(before), F.col("in_range")))
    counted = counted.select(*keys, "source_size", "target", F.col("passes").alias(passes), quota.alias(before))
    place = Window.partitionBy(*keys).orderBy(order, F.col(doc_id), tie)
    out = ranged.join(counted, keys).withColumn(rank, F.row_number().over(place))
    times = F.col(passes) + (F.col(rank) <= F.col(before)).cast("int")
    return out.withColumn("times", F.when(F.col("size") > 0, times).otherwise(0)).drop(key, rank, part, before, passes, order, tie)


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each row as often as it is taken, without the columns of `mix`."""
    at = fresh(mixed, "at")[0]
    repeated = mixed.where("times > 0").withColumn(at, F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.drop(at, "size", "source_size", "target", "times")
