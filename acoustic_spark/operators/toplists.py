"""Latest rows, top-n lists and sorted predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each key in the given total order, with their 1-based rank.

    Every map task keeps n rows per key while n is at most
    spark.sql.optimizer.windowGroupLimitThreshold; beyond it all rows of a key cross the shuffle.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The last row of each key by `order`; one value per key and task crosses the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
        .select(*keys, *[F.col("_last")[c].alias(c) for c in rest])
    )


def rows_of_latest(df: DataFrame, keys: Sequence[str], part: Sequence[str], order: str) -> DataFrame:
    """All rows of each key's newest part (a clip, say): the one with the greatest `order`.

    Only the parts' names and orders are compared, so what is built from the rows afterwards is built for one part a key.
    """
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*part), F.col(order)).alias("_part"))
    return df.join(newest.select(*keys, *[F.col("_part")[c].alias(c) for c in part]), [*keys, *part], "left_semi")


def latest_overall(df: DataFrame, *order: str) -> DataFrame:
    """The last row of the table by `order`."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(1)


def recent_events(df: DataFrame, keys: Sequence[str], ts: str, seq: str, n: int = 10) -> DataFrame:
    """The `n` most recent events per key, numbered 1..n from oldest to newest."""
    newest = top_n_per_key(df, keys, [F.desc(ts), F.desc(seq)], n, "_age")
    kept = Window.partitionBy(*keys)
    return newest.withColumn("rank", F.max("_age").over(kept) - F.col("_age") + 1).drop("_age")


def recent_events_overall(df: DataFrame, ts: str, seq: str, n: int = 10) -> DataFrame:
    """The `n` most recent events of all keys, oldest first."""
    return df.orderBy(F.desc(ts), F.desc(seq)).limit(n).orderBy(ts, seq)


def first_record(df: DataFrame, *order: str) -> DataFrame:
    """The first record of a batch."""
    return df.orderBy(*order).limit(1)


def detection_counts(df: DataFrame) -> DataFrame:
    """Totals, alerts and alert rate per sensor and day."""
    return df.groupBy("sensor_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col("flag") == 1).alias("gun_count"),
        F.avg("flag").alias("alert_rate"),
    )
