"""Column functions on sample arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from acoustic_spark.config import FULL_SCALE


def normalise(x: Column) -> Column:
    """One int16 sample as a fraction of full scale."""
    return x / F.lit(FULL_SCALE)


def normalise_array(samples: Column) -> Column:
    return F.transform(samples, normalise)


def channel_count(n_samples: Column, n_frames: Column | int) -> Column:
    """Channels of an interleaved buffer that holds `n_frames` frames; null if no whole number of them does."""
    frames = F.lit(n_frames) if isinstance(n_frames, int) else n_frames
    return F.when((frames > 0) & (n_samples >= frames) & (n_samples % frames == 0), F.call_function("div", n_samples, frames)).cast("int")


def mono_array(samples: Column, n_channels: Column) -> Column:
    """Mean over the channels of an interleaved array, of its whole frames; null without a channel or a whole frame."""
    frames = F.when(n_channels > 0, F.floor(F.size(samples) / n_channels)).cast("int")
    mixed = F.transform(
        F.sequence(F.lit(0), frames - 1),
        lambda f: F.aggregate(
            F.slice(samples, f * n_channels + 1, n_channels),
            F.lit(0.0),
            lambda total, x: total + x,
        )
        / n_channels,
    )
    # With no whole frame the sequence above would count downwards.
    return F.when(n_channels == 1, samples.cast("array<double>")).when(frames > 0, mixed)


def in_int16_range(x: Column) -> Column:
    return (x >= -32_768) & (x <= 32_767)


def checked_int16(x: Column) -> Column:
    """Cast to int16; a value that does not fit is an error, not a wrap-around."""
    return F.when(in_int16_range(x), x.cast("smallint")).otherwise(
        F.raise_error(F.concat(F.lit("bad sample: "), x.cast("string"))).cast("smallint")
    )


def has_frames(n_samples: Column, n_channels: Column, n_frames: int) -> Column:
    """The clip holds exactly `n_frames` frames. Filter on the stored count, which prunes row groups."""
    return n_samples == n_channels * n_frames


def frame_count(n: Column, window: int, hop: int) -> Column:
    """Complete windows in `n` samples."""
    return F.when(n >= window, F.floor((n - window) / hop) + 1).otherwise(0).cast("long")


def sample_time(i: Column, n: Column, sample_rate: int) -> Column:
    """Time of sample `i` on an axis from 0 to the whole seconds of the clip, both ends included."""
    whole_seconds = F.floor(n / sample_rate)
    return F.when(n > 1, i * whole_seconds / (n - 1)).otherwise(F.lit(0.0))


@F.arrow_udf(T.ArrayType(T.ShortType()))
def decode_pcm16(payload: pa.Array) -> pa.Array:
    """Little-endian 16-bit payload as a sample array; the value buffer is viewed, not copied."""
    start = np.frombuffer(payload.buffers()[1], dtype=np.int32)[payload.offset :][: len(payload) + 1]
    sizes = np.diff(start)
    if (start % 2).any() or (sizes % 2).any():
        raise ValueError("a 16-bit payload has an odd number of bytes")
    data = payload.buffers()[2] or pa.py_buffer(b"")
    values = pa.Array.from_buffers(pa.int16(), data.size // 2, [None, data])
    return pa.ListArray.from_arrays(
        pa.array(start // 2, pa.int32()), values, mask=payload.is_null() if payload.null_count else None
    )


@F.arrow_udf(T.BinaryType())
def encode_pcm16(samples: pa.Array) -> pa.Array:
    """Sample array as a little-endian 16-bit payload."""
    if samples.values.null_count:
        raise ValueError("a clip holds a null sample")
    values = samples.flatten() if samples.null_count == 0 else samples.fill_null([]).flatten()
    sizes = np.asarray(samples.value_lengths().fill_null(0), dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes * 2))).astype(np.int32)
    payload = np.asarray(values, dtype="<i2").tobytes()
    validity = None
    if samples.null_count:
        validity = pa.array(np.asarray(samples.is_valid())).buffers()[1]
    return pa.Array.from_buffers(
        pa.binary(), len(samples), [validity, pa.py_buffer(offsets), pa.py_buffer(payload)]
    )
