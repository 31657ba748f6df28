"""Magnitude spectrum, mel filter bank, log-mel features and patches.

There is one form for all sizes. The windows of the clips of an Arrow batch are stacked into blocks,
whichever clip they come from, and a block is transformed at once; what is held besides
samples and results is one block, however long a clip is. A long series is cut into
one array per patch first, so it takes the same path.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from acoustic_spark.config import MEL_BREAK_HZ, MEL_Q, FeatureConfig
from acoustic_spark.functions.arrow_lists import ARROW_TYPES, matrix_lists, raw_rows, regroup
from acoustic_spark.functions.spectral import hertz_to_mel
from acoustic_spark.operators.frames import patch_clips

# Windows that are transformed at once, and patches of an output batch.
BLOCK_WINDOWS = 1024
BLOCK_PATCHES = 64


def mel_table(spark: SparkSession, cfg: FeatureConfig) -> DataFrame:
    """Sparse mel weights (b, band, w): positive weights, plus the zero-weight bin 0 of every band.

    Bin 0 keeps a band that covers no bin in the result of an inner join.
    """
    nyquist = cfg.sample_rate / 2
    low = MEL_Q * math.log(1.0 + cfg.lower_hz / MEL_BREAK_HZ)
    step = (MEL_Q * math.log(1.0 + cfg.upper_hz / MEL_BREAK_HZ) - low) / (cfg.bands + 1)
    mel = hertz_to_mel(F.col("b") * F.lit(nyquist / (cfg.bins - 1)))
    rising = (mel - (F.lit(low) + F.col("band") * F.lit(step))) / F.lit(step)
    falling = (F.lit(low) + (F.col("band") + 2) * F.lit(step) - mel) / F.lit(step)
    weight = F.when(F.col("b") == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(rising, falling))
    )
    return (
        spark.range(cfg.bins)
        .select(
            F.col("id").cast("int").alias("b"),
            F.explode(F.sequence(F.lit(0), F.lit(cfg.bands - 1))).alias("band"),
        )
        .withColumn("w", weight)
        .filter((F.col("w") > 0) | (F.col("b") == 0))
    )


def _mel_matrix(cfg: FeatureConfig) -> np.ndarray:
    def mel(hz):
        return MEL_Q * np.log1p(np.asarray(hz) / MEL_BREAK_HZ)

    edges = np.linspace(mel(cfg.lower_hz), mel(cfg.upper_hz), cfg.bands + 2)
    position = mel(np.arange(cfg.bins) * (cfg.sample_rate / 2 / (cfg.bins - 1)))[:, None]
    rising = (position - edges[:-2]) / np.diff(edges)[:-1]
    falling = (edges[2:] - position) / np.diff(edges)[1:]
    weights = np.clip(np.minimum(rising, falling), 0.0, None)
    weights[0] = 0.0
    return weights


def _windows(samples: np.ndarray, window: int, hop: int) -> np.ndarray:
    if samples.size < window:
        return np.empty((0, window))
    return np.lib.stride_tricks.sliding_window_view(samples, window)[::hop]


def _window_counts(rows: list[np.ndarray], window: int, hop: int, multiple: int = 1) -> list[int]:
    """Complete windows of each row, cut to a multiple."""
    counts = (max(0, (len(x) - window) // hop + 1) for x in rows)
    return [n // multiple * multiple for n in counts]


def _stacked(rows: list[np.ndarray], counts: list[int], window: int, hop: int) -> Iterator[np.ndarray]:
    """The windows of all rows, in order, as blocks of doubles; each block is overwritten by the next."""
    block, at = np.empty((BLOCK_WINDOWS, window)), 0
    for x, count in zip(rows, counts):
        views = _windows(x, window, hop)
        first = 0
        while first < count:
            n = min(BLOCK_WINDOWS - at, count - first)
            block[at : at + n] = views[first : first + n]
            at, first = at + n, first + n
            if at == BLOCK_WINDOWS:
                yield block
                at = 0
    if at:
        yield block[:at]


def _hann(window: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(window) / window)


def _spectrum_kernel(window: int, fft: int) -> Callable[[np.ndarray], np.ndarray]:
    hann = _hann(window)
    return lambda block: np.abs(np.fft.rfft(block * hann, fft))


def _log_mel_kernel(cfg: FeatureConfig, scale: float = 1.0) -> Callable[[np.ndarray], np.ndarray]:
    hann, weights = _hann(cfg.window) / scale, _mel_matrix(cfg)
    return lambda block: np.log(np.abs(np.fft.rfft(block * hann, cfg.fft)) @ weights + cfg.log_offset)


def _transformed(
    rows: list[np.ndarray], counts: list[int], window: int, hop: int, width: int, kernel: Callable[[np.ndarray], np.ndarray], kind: str
) -> np.ndarray:
    """One matrix of `width` values for each window of all rows."""
    out, at = np.empty((sum(counts), width), kind), 0
    for block in _stacked(rows, counts, window, hop):
        out[at : at + len(block)] = kernel(block)
        at += len(block)
    return out


def magnitudes(samples: Column, window: int, hop: int, fft: int) -> Column:
    """Array of frames, each an array of fft/2+1 magnitudes."""

    @F.arrow_udf("array<array<double>>")
    def spectrum(column: pa.Array) -> pa.Array:
        rows = list(raw_rows(column))
        counts = _window_counts(rows, window, hop)
        out = _transformed(rows, counts, window, hop, fft // 2 + 1, _spectrum_kernel(window, fft), "double")
        return regroup(out, np.array(counts), pa.float64())

    return spectrum(samples)


def log_mel(samples: Column, cfg: FeatureConfig) -> Column:
    """Array of frames, each an array of `bands` log-mel values."""

    @F.arrow_udf("array<array<double>>")
    def features(column: pa.Array) -> pa.Array:
        rows = list(raw_rows(column))
        counts = _window_counts(rows, cfg.window, cfg.hop)
        out = _transformed(rows, counts, cfg.window, cfg.hop, cfg.bands, _log_mel_kernel(cfg), "double")
        return regroup(out, np.array(counts), pa.float64())

    return features(samples)


def patches(samples: Column, cfg: FeatureConfig, scale: float = 1.0) -> Column:
    """Array of complete patches, each a row-major array of patch_frames * bands values.

    Integer samples cross to Python as they are; `scale` divides them there.
    """
    value_type = ARROW_TYPES[cfg.value_type]

    @F.arrow_udf(f"array<array<{cfg.value_type}>>")
    def cut(column: pa.Array) -> pa.Array:
        rows = list(raw_rows(column))
        counts = _window_counts(rows, cfg.window, cfg.hop, cfg.patch_frames)
        out = _transformed(rows, counts, cfg.window, cfg.hop, cfg.bands, _log_mel_kernel(cfg, scale), cfg.value_type)
        return regroup(out.reshape(-1, cfg.patch_frames * cfg.bands), np.array(counts) // cfg.patch_frames, value_type)

    return cut(samples)


def patch_batches(batches: Iterator[pa.RecordBatch], samples: str, cfg: FeatureConfig, scale: float = 1.0) -> Iterator[pa.RecordBatch]:
    """One row per patch, in batches of BLOCK_PATCHES at most: a clip of any length is walked block by block."""
    kernel, value_type = _log_mel_kernel(cfg, scale), ARROW_TYPES[cfg.value_type]
    for batch in batches:
        rest = batch.drop_columns([samples])
        for at, x in enumerate(raw_rows(batch[samples])):
            whole = _window_counts([x], cfg.window, cfg.hop, cfg.patch_frames)[0] // cfg.patch_frames
            for first in range(0, whole, BLOCK_PATCHES):
                count = min(BLOCK_PATCHES, whole - first)
                # The piece ends with the overlap that its last window reads.
                piece = x[first * cfg.patch_hop : (first + count - 1) * cfg.patch_hop + cfg.patch_samples]
                found = _transformed([piece], [count * cfg.patch_frames], cfg.window, cfg.hop, cfg.bands, kernel, cfg.value_type)
                patch = matrix_lists(found.reshape(count, -1), value_type)
                kept = rest.take(pa.array(np.full(count, at)))
                example = pa.array(np.arange(first, first + count, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([*kept.columns, example, patch], names=[*rest.schema.names, "example", "patch"])


def clip_patches(clips: DataFrame, samples: str, cfg: FeatureConfig, scale: float = 1.0) -> DataFrame:
    """One row per patch of a clip table; narrow, no shuffle, and no clip's patches are held together."""
    kept = T.StructType([f for f in clips.schema.fields if f.name != samples])
    schema = kept.add("example", T.IntegerType()).add("patch", T.ArrayType(T.FloatType() if cfg.value_type == "float" else T.DoubleType()))
    return clips.mapInArrow(lambda batches: patch_batches(batches, samples, cfg, scale), schema)


def _blocks(series: DataFrame, keys: Sequence[str], window: int, hop: int, size: int) -> DataFrame:
    """Arrays of the samples of `size` frames, the last one of a key shorter: (key, example, samples)."""
    framing = FeatureConfig(window=window, hop=hop, patch_frames=size)
    return patch_clips(series, keys, framing, whole=False)


def _frame_values(blocks: DataFrame, keys: Sequence[str], size: int, values: Column, position: str, name: str) -> DataFrame:
    frames = blocks.select(*keys, "example", F.posexplode(values).alias("_at", "_values"))
    frame = (F.col("example") * size + F.col("_at")).alias("frame")
    return frames.select(*keys, "example", frame, F.posexplode("_values").alias(position, name))


def spectrum_rows(series: DataFrame, keys: Sequence[str], window: int, hop: int, fft: int, size: int = 96) -> DataFrame:
    """Magnitude rows (key, frame, b, mag) of a series, transformed in blocks of `size` frames."""
    blocks = _blocks(series, keys, window, hop, size)
    return _frame_values(blocks, keys, size, magnitudes(F.col("samples"), window, hop, fft), "b", "mag").drop("example")


def series_log_mel(series: DataFrame, keys: Sequence[str], cfg: FeatureConfig) -> DataFrame:
    """Log-mel rows (key, example, frame, band, v) of a series; one shuffle brings the samples of each patch together."""
    blocks = _blocks(series, keys, cfg.window, cfg.hop, cfg.patch_frames)
    return _frame_values(blocks, keys, cfg.patch_frames, log_mel(F.col("samples"), cfg), "band", "v")


def series_patches(series: DataFrame, keys: Sequence[str], cfg: FeatureConfig) -> DataFrame:
    """The whole feature step of a series: (key, example, patch)."""
    cut = patch_clips(series, keys, cfg)
    return cut.select(*keys, "example", patches(F.col("samples"), cfg)[0].alias("patch"))


def feature_rows(patches_table: DataFrame, keys: Sequence[str], bands: int) -> DataFrame:
    """Patch arrays back to one row per (frame in patch, band)."""
    return patches_table.select(*keys, "example", F.posexplode("patch").alias("cell", "v")).select(
        *keys,
        "example",
        F.floor(F.col("cell") / bands).cast("int").alias("frame"),
        (F.col("cell") % bands).cast("int").alias("band"),
        "v",
    )

