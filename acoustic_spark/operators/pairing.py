"""Selection, pairing, labelling and mixing of positive and negative examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.config import NEGATIVE_CLASSES, POSITIVE_CLASSES
from acoustic_spark.operators.positions import SLICE_ROWS, first_n, order_positions
from acoustic_spark.workspace import shared_folder


def with_any_label(meta: DataFrame, labels: Column, wanted: Sequence[str]) -> DataFrame:
    """Clips that carry at least one of the wanted labels."""
    return meta.filter(F.arrays_overlap(labels, F.array(*[F.lit(w) for w in wanted])))


def balanced(meta: DataFrame, label: str, seq: str, per_class: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The first `per_class` clips of each subclass by `seq`."""
    return first_n(meta, [label], seq, per_class, "_i", "_n", slice_rows).drop("_i", "_n")


def balanced_by_label(meta: DataFrame, labels: Column, seq: str, classes: Sequence[str], per_class: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(seq, label): `per_class` clips for each of `classes` from clips that may carry several of them, each clip chosen once.

    A clip counts for the rarest class that it carries (of equally rare ones for the first of `classes`), and each class takes its first
    clips by `seq`. A class that is short then takes from the clips that are left and carry it, in rounds, until no class is short of clips
    that are left. `seq` is a unique BIGINT; a clip without any of the classes is never chosen. Per round the counts of the classes
    alone come to the driver; later rounds read only clips that carry a short class.
    """
    spark = meta.sparkSession
    carried = meta.select(F.col(seq).cast("long").alias(seq), F.array_intersect(labels, F.array(*[F.lit(c) for c in classes])).alias("_labels"))
    carried = carried.where(F.size("_labels") > 0)
    counts = {r["label"]: r["n"] for r in carried.select(F.explode("_labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rarest = sorted((c for c in classes if c in counts), key=lambda c: (counts[c], classes.index(c)))
    short = {c: per_class for c in rarest}
    chosen: DataFrame | None = None
    while any(short.values()):
        wanted = [c for c in rarest if short[c]]
        open_ = carried.where(F.arrays_overlap("_labels", F.array(*[F.lit(c) for c in wanted])))
        if chosen is not None:
            open_ = open_.join(chosen.select(seq), seq, "left_anti")
        home = F.coalesce(*[F.when(F.array_contains("_labels", c), F.lit(c)) for c in wanted])
        limit = F.create_map(*[F.lit(v) for c in wanted for v in (c, short[c])])
        first = first_n(open_.select(seq, home.alias("label")), ["label"], seq, max(short.values()), "_i", "_n", slice_rows)
        folder = shared_folder(spark, "chosen")
        first.where(F.col("_i") < F.element_at(limit, F.col("label"))).select(seq, "label").write.parquet(folder)
        taken = spark.read.schema(f"{seq} BIGINT, label STRING").parquet(folder)
        found = {r["label"]: r["n"] for r in taken.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        chosen = taken if chosen is None else chosen.union(taken)
        if not found:
            break
        short = {c: n - found.get(c, 0) for c, n in short.items()}
    return chosen if chosen is not None else spark.createDataFrame([], f"{seq} BIGINT, label STRING")


def training_sets(meta: DataFrame, labels: Column, seq: str, per_positive: int, per_negative: int) -> DataFrame:
    """(seq, label, positive) of the configured class sets: clips with a positive class, and clips that carry only others."""
    any_positive = F.arrays_overlap(labels, F.array(*[F.lit(c) for c in POSITIVE_CLASSES]))
    sides = ((meta.where(any_positive), POSITIVE_CLASSES, per_positive, True), (meta.where(~any_positive), NEGATIVE_CLASSES, per_negative, False))
    found = [balanced_by_label(rows, labels, seq, classes, n).withColumn("positive", F.lit(side)) for rows, classes, n, side in sides]
    return found[0].unionByName(found[1])


def pair_by_position(positives: DataFrame, negatives: DataFrame, seq: str) -> tuple[DataFrame, DataFrame]:
    """Pair the i-th positive with the i-th negative by `seq`; positives left over come second.

    `seq` is a number or a path. Both sides are numbered over range-sorted partitions, so
    no side passes one task.
    """

    def numbered(side: DataFrame, name: str) -> DataFrame:
        return order_positions(side.select(F.col(seq).alias(name)), name, "rank")

    pos, neg = numbered(positives, "pos_id"), numbered(negatives, "neg_id")
    return pos.join(neg, "rank"), pos.join(neg, "rank", "left_anti")


def label_vector(positive: Column) -> Column:
    """`[1, 0]` for a positive example, `[0, 1]` for a negative one."""
    return F.when(positive, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))


def concatenate(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """Both sets in one table with their label vectors."""
    return positives.withColumn("labels", label_vector(F.lit(True))).unionByName(
        negatives.withColumn("labels", label_vector(F.lit(False)))
    )


def shuffle_key(seed: int, *identity: str) -> Column:
    """A seeded hash that any engine can compute: MD5 of the identity and the seed as text, joined by colons."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in identity], F.lit(str(seed))))


def shuffle_rows(rows: DataFrame, seed: int, *identity: str) -> DataFrame:
    """Random order that is the same in every run: by a seeded hash of the identity, then the identity."""
    return rows.orderBy(shuffle_key(seed, *identity), *identity)


def shuffled_ranks(rows: DataFrame, seed: int, identity: str, rank: str = "rank") -> DataFrame:
    """Rows with their place in that order as a column, so that the order outlives any later shuffle.

    `identity` is unique. Only the keys are sorted, in ranges; no task sees them all.
    """
    keyed = rows.withColumn("_key", F.struct(shuffle_key(seed, identity).alias("hash"), F.col(identity).alias("id")))
    placed = order_positions(keyed.select("_key"), "_key", rank).select(F.col("_key.id").alias(identity), rank)
    return rows.join(placed, identity)


#: A clip's examples are dealt to so many parts of a join.
PAIR_SALTS = 8


def mixed_batches(positives: DataFrame, negatives: DataFrame, key: str, seed: int) -> DataFrame:
    """Batches of all pairs at once: the examples of the i-th positive and i-th negative clip.

    Both inputs are stored tables with one row per example and the clip in `key`; each is read twice, once for its clips
    and once for the examples. The pair list, one row a clip, is repeated for each part of a clip's examples, so that a hot
    clip is joined in PAIR_SALTS tasks. The order inside a batch is a seeded random one, by `batch_order`.
    """
    both = concatenate(positives, negatives).withColumn("_salt", F.pmod("example", F.lit(PAIR_SALTS)).cast("int"))
    pairs, _ = pair_by_position(positives.select(key).distinct(), negatives.select(key).distinct(), key)
    members = pairs.select(F.col("rank").alias("batch_id"), F.explode(F.array(*[
        F.struct(F.col(c).alias(key), label_vector(F.lit(side)).alias("labels"), F.lit(salt).alias("_salt"))
        for c, side in (("pos_id", True), ("neg_id", False)) for salt in range(PAIR_SALTS)
    ])).alias("m")).select("batch_id", "m.*")
    return both.join(members, [key, "labels", "_salt"]).drop("_salt").withColumn("batch_order", F.xxhash64(key, "example", F.lit(seed)))
