"""Row positions within a key that hold up under skew.

A plain `row_number() over (partition by key)` puts a whole key into one task.
Here the unique sequence number is cut into slices: a slice spans `slice_rows`
sequence values, so no (key, slice) group can hold more rows than that, however
hot the key. The start of each slice comes from a small table of slice sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustic_spark.workspace import shared_folder

SLICE_ROWS = 1 << 20
BLOCK_SLICES = 1 << 20


def _slice(number: str, size: int) -> Column:
    """Whole-number division, exact for every BIGINT."""
    return F.call_function("div", F.col(number), F.lit(size)).cast("long")


def slice_starts(df: DataFrame, keys: Sequence[str], seq: str, slice_rows: int) -> DataFrame:
    """Per (key, slice): position of its first row, and the row count of the whole key.

    With wide gaps in the numbers a key may have about as many slices as rows, so they
    are summed in blocks first: no window sees more than a block of them.
    """
    sizes = (
        df.select(*keys, _slice(seq, slice_rows).alias("_slice"))
        .groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )

    def before(size: str, order: str, *groups: str) -> Column:
        rows = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(rows), F.lit(0))

    blocked = sizes.withColumn("_block", _slice("_slice", BLOCK_SLICES))
    blocks = (
        blocked.groupBy(*keys, "_block")
        .agg(F.sum("_rows").alias("_block_rows"))
        .select(
            *keys,
            "_block",
            before("_block_rows", "_block", *keys).alias("_block_start"),
            F.sum("_block_rows").over(Window.partitionBy(*keys)).alias("_total"),
        )
    )
    inside = blocked.withColumn("_inside", before("_rows", "_slice", *keys, "_block"))
    return inside.join(blocks, [*keys, "_block"]).select(
        *keys, "_slice", (F.col("_block_start") + F.col("_inside")).alias("_start"), "_total"
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    position: str = "i",
    total: str = "n",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the 0-based position by `seq` within `keys`, and the row count of the key.

    `seq` must be a unique BIGINT and `keys` must not be null; its numbers may have gaps.
    """
    starts = slice_starts(df, keys, seq, slice_rows)
    local = Window.partitionBy(*keys, "_slice").orderBy(seq)
    # The window comes first: its sort order also serves the join with the starts.
    return (
        df.withColumn("_slice", _slice(seq, slice_rows))
        .withColumn("_local", F.row_number().over(local) - 1)
        .join(starts, [*keys, "_slice"], "left")
        .withColumn(position, F.col("_start") + F.col("_local"))
        .withColumnRenamed("_total", total)
        .drop("_slice", "_local", "_start")
    )


def first_n(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    n: int,
    position: str = "i",
    total: str = "n",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The first `n` rows of each key by `seq`, exact for any `n`.

    Only slices that start before position `n` are numbered; the adaptive planner
    broadcasts their list when its measured size allows.
    """
    starts = slice_starts(df, keys, seq, slice_rows).filter(F.col("_start") < n)
    local = Window.partitionBy(*keys, "_slice").orderBy(seq)
    return (
        df.withColumn("_slice", _slice(seq, slice_rows))
        .join(starts, [*keys, "_slice"])
        .withColumn(position, F.col("_start") + F.row_number().over(local) - 1)
        .filter(F.col(position) < n)
        .withColumnRenamed("_total", total)
        .drop("_slice", "_start")
    )


def order_positions(df: DataFrame, key: str, position: str = "i") -> DataFrame:
    """(key, 0-based position) of all rows in the order of `key`, a column of any type that sorts.

    The keys are range-partitioned and sorted within partitions; a partition's start comes
    from the row counts of those before it, one row each. The sorted keys are written to
    the shared folder first, as a second run may cut the ranges elsewhere. A repeated key
    has as many positions as rows.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "ordered")
    placed = df.select(key).repartitionByRange(key).sortWithinPartitions(key)
    marked = placed.select(key, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    marked.write.parquet(folder)
    rows = spark.read.schema(marked.schema).parquet(folder)
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return rows.join(starts, "_part").select(key, (F.col("_id") + F.col("_shift")).alias(position))
