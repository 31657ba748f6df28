"""Capture buffer over a stored chunk series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def capture_rows(
    series: DataFrame, keys: Sequence[str], chunk: int, min_chunks: int, max_chunks: int
) -> DataFrame:
    """Batch twin of the live buffer for a consumer that is always ready.

    The buffer is handed over and cleared at the first chunk that brings it to
    `min_chunks`; a tail that never gets there is not handed over. Rows are the
    samples of complete buffers, at most the newest `max_chunks` chunks of each.
    """
    if min_chunks > max_chunks:
        raise ValueError("the minimum is greater than the maximum")
    size = chunk * min_chunks
    complete = F.floor(F.floor(F.col("n") / chunk) * chunk / size)
    return series.withColumn("buffer", F.floor(F.col("i") / size)).filter(F.col("buffer") < complete)
