"""Change of the sample rate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.functions.arrow_lists import flat_lists, list_rows
from acoustic_spark.operators.frames import explode_range


def _bessel(x: Column, beta: float) -> Column:
    """Modified Bessel function of order 0 of numbers from 0 to beta, by its power series until a term no longer counts."""
    quarter = x * x / 4
    terms, size = 1, 1.0
    while size > 1e-18:
        size *= beta * beta / 4 / terms**2
        terms += 1
    total = F.lit(1.0)
    for k in range(terms, 0, -1):
        total = F.lit(1.0) + total * quarter / float(k * k)
    return total


def _sinc_weight(away: Column, half: int, cutoff: float, beta: float) -> Column:
    """Weight of a sample so many input samples away from an output."""
    angle = away * (np.pi * cutoff)
    sinc = F.when(away == 0, 1.0).otherwise(F.sin(angle) / angle)
    inside = F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - away * away / float(half * half)))
    return sinc * _bessel(inside * beta, beta) * (cutoff / float(np.i0(beta)))


def resample_series(
    series: DataFrame, keys: Sequence[str], source_rate: int, target_rate: int, kernel: str = "linear", zero_crossings: int = 16, beta: float = 8.6
) -> DataFrame:
    """A series (key, i, n, x) at the target rate, by the kernels of `resample_array`.

    Each sample is sent to the outputs whose taps reach it, with the weight of its distance, and the products are
    added up by (key, output): an equi-grouping, added up in each task before the shuffle. Past the ends the signal is zero.
    """
    if kernel not in ("sinc", "linear"):
        raise ValueError(f"unknown kernel {kernel!r}")
    if source_rate == target_rate:
        return series.select(*keys, F.col("i").cast("long").alias("i"), F.col("n").cast("long").alias("n"), "x")
    common = gcd(source_rate, target_rate)
    up, down = target_rate // common, source_rate // common
    cutoff = min(1.0, up / down)
    half = int(np.ceil(zero_crossings / cutoff)) if kernel == "sinc" else 1
    out_n = F.floor(F.col("n") * up / down).cast("long")
    # Output j lies at input position j * down / up. Its taps reach from `half` samples after it (with weight) to less than `half` before.
    first = F.floor((F.col("i") - half) * up / down) + 1 if kernel == "linear" else F.ceil((F.col("i") - half) * up / down)
    rows = explode_range(
        series.withColumn("_out_n", out_n),
        "_j",
        F.greatest(F.lit(0), first),
        F.least(F.ceil((F.col("i") + half) * up / down) - 1, F.col("_out_n") - 1),
    )
    away = (F.col("_j") * down - F.col("i") * up) / F.lit(up)
    weight = _sinc_weight(away, half, cutoff, beta) if kernel == "sinc" else F.lit(1.0) - F.abs(away)
    return (
        rows.groupBy(*keys, F.col("_j").alias("_at"))
        .agg(F.sum(F.col("x") * weight).alias("x"), F.max("_out_n").alias("n"))
        .withColumnRenamed("_at", "i")
    )


def _kernel(away: np.ndarray, kernel: str, half: int, cutoff: float, beta: float) -> np.ndarray:
    """Weights of taps at the given distances from the output position."""
    if kernel == "linear":
        return np.clip(1.0 - np.abs(away), 0.0, None)
    taper = np.i0(beta * np.sqrt(np.clip(1.0 - (away / half) ** 2, 0.0, None))) / np.i0(beta)
    return cutoff * np.sinc(cutoff * away) * taper * (np.abs(away) <= half)


def _converter(
    target_rate: int, kernel: str, zero_crossings: int, beta: float
) -> Callable[[np.ndarray, int], np.ndarray]:
    if kernel not in ("sinc", "linear"):
        raise ValueError(f"unknown kernel {kernel!r}")

    def convert(x: np.ndarray, source_rate: int) -> np.ndarray:
        if source_rate == target_rate:
            return x
        common = gcd(source_rate, target_rate)
        up, down = target_rate // common, source_rate // common
        cutoff = min(1.0, up / down)
        half = int(np.ceil(zero_crossings / cutoff)) if kernel == "sinc" else 1
        out = np.empty(len(x) * up // down)
        windows = np.lib.stride_tricks.sliding_window_view(np.pad(x, half), 2 * half)
        taps = np.arange(1 - half, half + 1)
        # Every up-th output lies at the same place between two samples, so it has the same weights.
        for phase in range(min(up, len(out))):
            whole, part = divmod(phase * down, up)
            same = out[phase::up]
            same[:] = windows[whole + 1 :: down][: len(same)] @ _kernel(part / up - taps, kernel, half, cutoff, beta)
        return out

    return convert


def resample_array(
    samples: Column,
    rate: Column,
    target_rate: int,
    kernel: str = "sinc",
    zero_crossings: int = 16,
    beta: float = 8.6,
) -> Column:
    """Resampled array of a clip; a clip already at the target rate passes as it is.

    `sinc` is a Kaiser-windowed low-pass over `zero_crossings` lobes on each side,
    `linear` the two-point kernel. Past the ends the signal is zero.
    """
    convert = _converter(target_rate, kernel, zero_crossings, beta)

    @F.arrow_udf("array<double>")
    def resample(column: pa.Array, rates: pa.Array) -> pa.Array:
        return flat_lists([convert(x, int(r)) for x, r in zip(list_rows(column), np.asarray(rates))], pa.float64())

    return resample(samples, rate)


def mono_signal(
    samples: Column,
    n_channels: Column,
    rate: Column,
    target_rate: int,
    kernel: str = "sinc",
    zero_crossings: int = 16,
    beta: float = 8.6,
) -> Column:
    """Mean over the interleaved channels at the target rate.

    An incomplete last frame is left out (the intake rejects such clips); without a channel there is no signal.

    One Arrow step for both, so that it joins up with the decoding before it and
    the features after it.
    """
    convert = _converter(target_rate, kernel, zero_crossings, beta)

    def mix(x: np.ndarray, channels: int) -> np.ndarray:
        if channels < 1:
            return x[:0]
        return x if channels == 1 else x[: len(x) // channels * channels].reshape(-1, channels).mean(axis=1)

    @F.arrow_udf("array<double>")
    def signal(column: pa.Array, channels: pa.Array, rates: pa.Array) -> pa.Array:
        rows = zip(list_rows(column), np.asarray(channels), np.asarray(rates))
        return flat_lists([convert(mix(x, int(c)), int(r)) for x, c, r in rows], pa.float64())

    return signal(samples, n_channels, rate)
