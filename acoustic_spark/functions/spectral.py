"""Column formulas of the window, the mel scale and the quantiser."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from acoustic_spark.config import MEL_BREAK_HZ, MEL_Q, QUANTIZE_LEVELS, QUANTIZE_MAX, QUANTIZE_MIN


def periodic_hann(k: Column, window: int) -> Column:
    return F.lit(0.5) - F.lit(0.5) * F.cos(k * F.lit(2 * math.pi) / F.lit(window))


def hertz_to_mel(hz: Column) -> Column:
    return F.lit(MEL_Q) * F.ln(F.lit(1.0) + hz / F.lit(MEL_BREAK_HZ))


def quantize(y: Column) -> Column:
    """Clip to the fixed range and truncate to 0..255."""
    clipped = F.greatest(F.lit(QUANTIZE_MIN), F.least(F.lit(QUANTIZE_MAX), y))
    scale = QUANTIZE_LEVELS / (QUANTIZE_MAX - QUANTIZE_MIN)
    return F.floor((clipped - F.lit(QUANTIZE_MIN)) * F.lit(scale)).cast("int")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def sigmoid_cross_entropy(z: Column, y: Column) -> Column:
    """Logistic loss of logit `z` for label `y`, in the form that cannot overflow."""
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
