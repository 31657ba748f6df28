"""Loss, embedding statistics and confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.functions.spectral import sigmoid_cross_entropy

# Expected statistics of quantised embeddings and their tolerance.
EXPECTED_MEAN = 123.0
EXPECTED_STD = 75.0
TOLERANCE = 0.1


def mean_cross_entropy(rows: DataFrame, logit: Column, label: Column) -> DataFrame:
    return rows.agg(F.avg(sigmoid_cross_entropy(logit, label)).alias("loss"))


def embedding_statistics(
    values: DataFrame, value: str, mean: float = EXPECTED_MEAN, std: float = EXPECTED_STD, tolerance: float = TOLERANCE
) -> DataFrame:
    """Mean and standard deviation of all values, and whether both are close to the expected ones."""
    stats = values.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))

    def close(found: str, expected: float) -> Column:
        return F.abs(F.col(found) - F.lit(expected)) <= F.lit(tolerance * abs(expected))

    return stats.withColumn("ok", (close("mean", mean) & close("std", std)).cast("int"))


def confusion_counts(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    return rows.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))
