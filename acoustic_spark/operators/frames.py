"""Windows, patches and fixed-length lists over sample series.

A series is a long table: one row per sample with its key columns, its position
`i`, the key's row count `n` and the value `x` (see positions.with_position).
Windows are found by exploding the window numbers a sample belongs to, so the
grouping is an equi-shuffle on (key, window), never a range join, and no group
is larger than one window or one patch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.config import FeatureConfig
from acoustic_spark.functions.waveform import frame_count


def explode_range(df: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
    """One row per whole number in [first, last]; rows with an empty range go."""
    return (
        df.withColumn("_first", first.cast("long"))
        .withColumn("_last", last.cast("long"))
        .filter(F.col("_first") <= F.col("_last"))
        .withColumn(name, F.explode(F.sequence("_first", "_last")))
        .drop("_first", "_last")
    )


def _first_window(i: Column, window: int, hop: int) -> Column:
    return F.greatest(F.lit(0), F.ceil((i - (window - 1)) / hop))


def frame_rows(
    series: DataFrame, keys: Sequence[str], window: int, hop: int, frame: str = "frame", offset: str = "k"
) -> DataFrame:
    """Complete overlapping windows: one row per (key, frame, offset in the window)."""
    frames = frame_count(F.col("n"), window, hop)
    rows = explode_range(
        series,
        frame,
        _first_window(F.col("i"), window, hop),
        F.least(F.floor(F.col("i") / hop), frames - 1),
    )
    return rows.select(
        *keys, frame, (F.col("i") - F.col(frame) * hop).cast("int").alias(offset), "x"
    )


def frame_arrays(clips: DataFrame, samples: str, window: int, hop: int) -> DataFrame:
    """Complete windows of a clip table: one row per (clip, frame) with the window as an array."""
    n_frames = frame_count(F.size(samples), window, hop)
    starts = F.when(n_frames > 0, F.sequence(F.lit(0).cast("long"), n_frames - 1))
    return clips.withColumn("frame", F.explode(starts)).withColumn(
        samples, F.slice(samples, (F.col("frame") * hop + 1).cast("int"), F.lit(window))
    )


def patch_clips(series: DataFrame, keys: Sequence[str], cfg: FeatureConfig, whole: bool = True) -> DataFrame:
    """Cut a series of any length into one sample array per patch, with the overlap it needs.

    A sample goes to the one or two patches whose windows read it, so the shuffle
    moves the data about once, and the arrays hold `cfg.patch_samples` values
    however long the series is. Everything after this step is row by row. Without `whole`
    there is a last, shorter array for the frames that fill no patch.
    """
    patches = frame_count(F.col("n"), cfg.window, cfg.hop) / cfg.patch_frames
    n_patches = F.floor(patches) if whole else F.ceil(patches)
    rows = explode_range(
        series,
        "example",
        _first_window(F.col("i"), cfg.patch_samples, cfg.patch_hop),
        F.least(F.floor(F.col("i") / cfg.patch_hop), n_patches - 1),
    )
    return (
        rows.groupBy(*keys, "example")
        .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_rows"))
        .select(*keys, "example", F.col("_rows.x").alias("samples"))
    )


def resize_array(values: Column, size: int, fill: float = 0.0) -> Column:
    """Cut to `size` items, or pad with `fill`."""
    return F.slice(
        F.concat(values.cast("array<double>"), F.array_repeat(F.lit(fill), F.greatest(F.lit(0), size - F.size(values)))),
        1,
        size,
    )


def valid_count(n: Column, size: int) -> Column:
    return F.least(n, F.lit(size)).cast("int")


def resize_rows(rows: DataFrame, keys: Sequence[str], position: str, value: str, size: int) -> DataFrame:
    """Long form of the resize: positions 0..size-1 for every key, zero where there is no row."""
    kept = rows.filter(F.col(position) < size)
    counts = rows.groupBy(*keys).agg(F.least(F.count(F.lit(1)), F.lit(size)).cast("int").alias("n_valid"))
    grid = counts.withColumn(position, F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    return grid.join(
        kept.select(*keys, F.col(position).cast("int").alias(position), value), [*keys, position], "left"
    ).withColumn(value, F.coalesce(value, F.lit(0.0)))
