"""Language identification by word-first backoff.

Known words are scored by their log frequency in each language. A word that is not known is
scored by its longest character n-grams, and by shorter and shorter ones where none of
those is known.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import discard, fresh, in_small_batches, join_counted, text_or_empty, written

LETTERS = re.compile(r"[^\W\d_]+")  # and numbers that are no digits, which `words` leaves out
#: Different words for each task that counts their n-grams.
WORDS_A_TASK = 50_000
#: Lengths of character n-grams, longest first; a word is taken with a mark at both ends.
ORDERS = (5, 4, 3, 2, 1)
#: The most frequent words and n-grams go to every task. This bounds the broadcast only: all
#: others keep their counts and are joined by shuffle.
HOT_WORDS, HOT_GRAMS = 60_000, 60_000
#: Different counts a task holds before it passes them on.
HELD = 300_000
UNKNOWN = "und"
SMOOTHING = 0.5


def words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = LETTERS.findall(text.lower())
    if text.isascii() or "".join(found).isalpha():
        return found
    return [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def grams(word: str, order: int) -> list[str]:
    """n-grams of the word between marks; single letters without marks."""
    if order == 1:
        return list(word)
    marked = f"\x02{word}\x03"
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


@dataclass
class Statistics:
    """Languages, and for all words and n-grams how often each language has them (in this order).

    `words` and `grams` have item, all and counts; sizes are the sums by language. `hot` is
    what every task gets of them.
    """

    languages: list[str]
    words: DataFrame
    grams: DataFrame
    word_sizes: list[float]
    gram_sizes: list[float]
    hot: Hot


@dataclass
class Hot:
    """Log frequencies of the most frequent words, and the most frequent n-grams."""

    words: dict[str, int]
    word_scores: np.ndarray
    grams: frozenset[str]

    def split(self, text: str) -> tuple[bool, np.ndarray, list[str], list[int]]:
        """Whether text has words, the summed scores of its hot ones, and the others with their counts."""
        counts = Counter(words(text))
        hot = [(self.words[w], n) for w, n in counts.items() if w in self.words]
        total = np.zeros(self.word_scores.shape[1])
        if hot:
            at, n = zip(*hot)
            total = np.array(n, float) @ self.word_scores[list(at)]
        others = [w for w in counts if w not in self.words]
        return bool(counts), total, others, [counts[w] for w in others]

    def pieces(self, word: str) -> Iterator[tuple[int, str, int]]:
        """Order, n-gram and occurrences, for the orders down to the first with a hot n-gram: that one surely is known."""
        for order in ORDERS:
            found = Counter(grams(word, order))
            for gram, n in found.items():
                yield order, gram, n
            if not self.grams.isdisjoint(found):
                return


def _counted(held: dict[str, dict[str, int]], item: str) -> pd.DataFrame:
    """Rows (lang, item, n), column by column: a tuple for each row would take twice the counts' own memory."""
    sizes = [len(each) for each in held.values()]
    items = [x for each in held.values() for x in each]
    n = np.fromiter((c for each in held.values() for c in each.values()), np.int64, len(items))
    lang = np.repeat(np.array(list(held), object), np.array(sizes, int))
    return pd.DataFrame({"lang": pd.Series(lang, dtype=object), item: pd.Series(items, dtype=object), "n": n})


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            held.setdefault(lang, Counter()).update(words(text))
            if sum(map(len, held.values())) >= HELD:
                yield _counted(held, "word")
                held = {}
    yield _counted(held, "word")


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, dict[str, int]] = {}
    for batch in batches:
        for at, (lang, word, n) in enumerate(zip(batch["lang"], batch["word"], batch["n"])):
            each = held.setdefault(lang, {})
            for order in ORDERS:
                for gram in grams(word, order):
                    each[gram] = each.get(gram, 0) + n
            if at % 1000 == 0 and sum(map(len, held.values())) >= HELD:
                yield _counted(held, "gram")
                held = {}
    yield _counted(held, "gram")


def _table(counts: DataFrame, item: str, languages: list[str]) -> DataFrame:
    """Every item once, with all occurrences and those of each language."""
    by = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    whole = counts.groupBy(F.col(item).alias("item")).agg(F.sum("n").alias("all"), by.alias("by"))
    each = F.array(*[F.coalesce(F.col("by")[F.lit(lang)], F.lit(0).cast("long")) for lang in languages])
    return written(whole.select("item", "all", each.cast("array<long>").alias("counts")), f"{item}_table")


def _tally(table: DataFrame) -> dict[int, int]:
    """How many items have an `all` of so many binary digits."""
    return {r["digits"]: r["n"] for r in table.groupBy(F.length(F.bin("all")).alias("digits")).agg(F.count(F.lit(1)).alias("n")).collect()}


def _most_frequent(table: DataFrame, n: int, tally: dict[int, int]) -> DataFrame:
    """The n items with the most occurrences, equal ones by name.

    Items with fewer binary digits than enough others have are left out before, so what the
    tasks sort and send does not grow by n with each of them.
    """
    held, least = 0, 1
    for digits in sorted(tally, reverse=True):
        held, least = held + tally[digits], digits
        if held >= n:
            break
    return table.where(F.col("all") >= F.lit(1 << (least - 1))).orderBy(F.desc("all"), "item").limit(n)


def _scores(counts: str, sizes: list[float]) -> F.Column:
    """Log frequencies by language of an item with these counts."""
    return F.array(*[F.log((F.col(counts)[i] + F.lit(SMOOTHING)) / F.lit(size)) for i, size in enumerate(sizes)])


@in_small_batches
def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Statistics:
    """The counts of every word and n-gram of every text of all rows with a language."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text_or_empty(text).alias("text"))
    counts = rows.mapInPandas(_count_words, "lang string, word string, n long")
    counts = written(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    tasks = 1 + counts.count() // WORDS_A_TASK
    gram_counts = written(counts.repartition(tasks, "word").mapInPandas(_count_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    gram_totals = {r["lang"]: r["n"] for r in gram_counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    whole, pieces = _table(counts, "word", languages), _table(gram_counts, "gram", languages)
    discard(counts, gram_counts)
    word_tally, gram_tally = _tally(whole), _tally(pieces)
    n_words, n_grams = sum(word_tally.values()), sum(gram_tally.values())
    sizes = [totals[lang] + SMOOTHING * max(1, n_words) for lang in languages]
    gram_sizes = [gram_totals[lang] + SMOOTHING * max(1, n_grams) for lang in languages]
    top = _most_frequent(whole, HOT_WORDS, word_tally).select("item", "counts").toArrow()
    n = top["counts"].combine_chunks().flatten().to_numpy().astype(float).reshape(len(top), len(languages))
    top_grams = _most_frequent(pieces, HOT_GRAMS, gram_tally).select("item").toArrow()
    hot = Hot({w: i for i, w in enumerate(top["item"].to_pylist())}, np.log((n + SMOOTHING) / np.array(sizes)), frozenset(top_grams["item"].to_pylist()))
    return Statistics(languages, whole, pieces, sizes, gram_sizes, hot)


def is_held_out(doc_id: str) -> F.Column:
    """Whether crc32 of the id as text leaves remainder 0 by 5; true for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _summed(scores: str, times: str, n: int) -> list[F.Column]:
    return [F.sum(F.col(scores)[i] * F.col(times)).alias(f"s{i}") for i in range(n)]


def _backoff(unknown: DataFrame, model: Statistics, shared) -> tuple[DataFrame, DataFrame]:
    """item, n_rows and scores of words (item, n_rows) without a count: the mean of their longest known n-grams. Words without any are left out.

    Also the written table that this reads.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, m, *piece) for w, m in zip(batch["item"], batch["n_rows"]) for piece in shared.value.pieces(w)]
            yield pd.DataFrame(rows, columns=["word", "n_rows", "order", "item", "times"])

    n = len(model.languages)
    pieces = written(unknown.select("item", "n_rows").mapInPandas(run, "word string, n_rows long, order int, item string, times long"), "pieces")
    known = pieces.groupBy("item").agg(F.count(F.lit(1)).alias("n_pieces")).join(model.grams.select("item", "counts"), "item")
    found = join_counted(pieces, known.select("item", "n_pieces", _scores("counts", model.gram_sizes).alias("scores")), "item", "n_pieces", pieces.count())
    by_order = found.groupBy("word", "order").agg(F.max("n_rows").alias("n_rows"), F.sum("times").alias("times"), *_summed("scores", "times", n))
    scores = F.array(*[F.col(f"s{i}") / F.col("times") for i in range(n)])
    longest = by_order.groupBy("word").agg(F.max("n_rows").alias("n_rows"), F.max_by(scores, "order").alias("scores"))
    return longest.select(F.col("word").alias("item"), "n_rows", "scores"), pieces


@in_small_batches
def identify(docs: DataFrame, model: Statistics, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score (0 to 1). A null text or one without letters gives `und` and 0.

    The language is the most probable one, the first by name of equal ones; without any
    language it is `und`. Every word counts by the whole statistics: a task adds up the hot
    ones, all others meet their counts, or those of their n-grams, in joins. Texts are told
    apart by 16 bytes of their SHA-256.

    Every row keeps its place, repeated rows get equal results, an empty table gives an
    empty result. Columns of these names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    n = len(model.languages)
    if not n:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model.hot)
    digest = F.substring(F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256)), 1, 16)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key, *shared.value.split(t)) for key, t in zip(batch["key"], batch["text"])]
            yield pd.DataFrame(rows, columns=["key", "worded", "sums", "words", "ns"])

    parts = docs.select(digest.alias("key"), text_or_empty(text).alias("text"))
    parts = written(parts.mapInPandas(split, "key binary, worded boolean, sums array<double>, words array<string>, ns array<long>"), "parts")
    cold = parts.select("key", F.explode(F.arrays_zip("words", "ns")).alias("w")).select("key", F.col("w.words").alias("item"), F.col("w.ns").alias("n"))
    seen = written(cold.groupBy("item").agg(F.count(F.lit(1)).alias("n_rows")), "seen")
    table = model.words.select("item", "counts")
    known = seen.join(table, "item").select("item", "n_rows", _scores("counts", model.word_sizes).alias("scores"))
    rest, pieces = _backoff(seen.join(table.select("item"), "item", "left_anti"), model, shared)
    vectors = written(known.unionByName(rest), "vectors")
    shared.destroy()
    n_cold = seen.agg(F.sum("n_rows")).first()[0] or 0
    discard(pieces, seen)
    added = join_counted(cold, vectors, "item", "n_rows", n_cold).groupBy("key").agg(*_summed("scores", "n", n))

    # Rows of equal texts have one key: what their words add comes once for each of them.
    whole = parts.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.max("worded").alias("worded"), *[F.max(F.col("sums")[i]).alias(f"t{i}") for i in range(n)])
    whole = whole.join(added, "key", "left")
    totals = F.array(*[F.col(f"t{i}") + F.coalesce(F.col(f"s{i}"), F.lit(0.0)) / F.col("copies") for i in range(n)])
    whole = whole.select("key", "copies", "worded", totals.alias("totals")).withColumn("top", F.array_max("totals"))
    best = F.element_at(F.array(*map(F.lit, model.languages)), F.array_position("totals", F.col("top")).cast("int"))
    share = 1 / F.aggregate("totals", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    key, copies, lang, score = fresh(docs, "key", "copies", "lang", "score")
    found = whole.select(F.col("key").alias(key), F.col("copies").alias(copies), F.when(F.col("worded"), best).otherwise(UNKNOWN).alias(lang), F.when(F.col("worded"), share).otherwise(0.0).alias(score))
    found, n_rows = written(found, "found"), parts.count()
    discard(parts, vectors)
    out = join_counted(docs.withColumn(key, digest), found, key, copies, n_rows)
    return out.select(*keep, F.col(lang).alias("lang_pred"), F.col(score).alias("score"))


def identify_all(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with held_out, lang_pred and score; the statistics are those of all rows that are not held out and have a language."""
    docs = docs.withColumn("held_out", is_held_out(doc_id))
    model = fit(docs.where(~F.col("held_out")), text, lang)
    done = identify(docs, model, text)
    discard(model.words, model.grams)
    return done
