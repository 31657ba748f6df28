"""Small side tables: class dictionary, clip metadata, projection, training metrics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.operators.scoring import Projection
from acoustic_spark.schemas import CLASSES, CLIP_META, PROJECTION, PROJECTION_MEAN


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """Class id and display name from the dictionary CSV (index, mid, display_name)."""
    return spark.read.csv(path, header=True, schema=CLASSES, escape='"').select("class_id", "display_name")


def read_clip_meta(spark: SparkSession, path: str) -> DataFrame:
    """Clip id, start, end and label list; lines that start with # are comments."""
    rows = spark.read.csv(
        path, schema=CLIP_META, comment="#", escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    return rows.withColumn("labels", F.split("labels", r"\s*,\s*"))


def load_projection(pca: DataFrame, pca_mean: DataFrame, out_dim: int, in_dim: int | None = None) -> Projection:
    """Matrix and mean with their shapes checked; at most `out_dim * in_dim` rows are read."""
    in_dim = out_dim if in_dim is None else in_dim
    weights = pca.select("o", "i", "w").limit(out_dim * in_dim + 1).toPandas()
    means = pca_mean.select("i", "m").limit(in_dim + 1).toPandas()
    inside = weights["o"].between(0, out_dim - 1) & weights["i"].between(0, in_dim - 1)
    if len(weights) != out_dim * in_dim or not inside.all() or weights.duplicated(["o", "i"]).any():
        raise ValueError(f"bad matrix shape: expected {out_dim} x {in_dim}")
    if len(means) != in_dim or not means["i"].between(0, in_dim - 1).all() or means["i"].duplicated().any():
        raise ValueError(f"bad mean shape: expected {in_dim}")
    matrix, mean = np.empty((out_dim, in_dim)), np.empty(in_dim)
    matrix[weights["o"], weights["i"]] = weights["w"]
    mean[means["i"]] = means["m"]
    return Projection(matrix, mean)


def read_projection(spark: SparkSession, pca: str, pca_mean: str, out_dim: int, in_dim: int | None = None) -> Projection:
    return load_projection(
        spark.read.schema(PROJECTION).parquet(pca), spark.read.schema(PROJECTION_MEAN).parquet(pca_mean), out_dim, in_dim
    )


def metric_log(steps: DataFrame, every: int = 10) -> DataFrame:
    """Every `every`-th training step, from step 0."""
    return steps.filter(F.col("step") % every == 0)


def append_metrics(steps: DataFrame, path: str, every: int = 10) -> None:
    metric_log(steps, every).write.mode("append").parquet(path)
