"""Logistic heads on embeddings, and the evaluation sets. `plans.head` has the head with a hidden layer."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acoustic_spark.operators.quality import confusion_counts
from acoustic_spark.schemas import METRICS
from acoustic_spark.workspace import local_table


def _features(examples: DataFrame, target: Column) -> DataFrame:
    return examples.select(
        *[c for c in examples.columns if c not in ("features", "label")],
        array_to_vector(F.col("embedding")).alias("features"),
        target.cast("double").alias("label"),
    )


def fit_logistic_heads(
    examples: DataFrame, n_classes: int = 2, max_iter: int = 50, reg: float = 1e-3
) -> list[LogisticRegressionModel]:
    """One independent logistic output per class, from label vectors in `labels`."""
    fit = LogisticRegression(maxIter=max_iter, regParam=reg)
    return [fit.fit(_features(examples, F.col("labels")[c])) for c in range(n_classes)]


def apply_logistic_heads(examples: DataFrame, models: list[LogisticRegressionModel]) -> DataFrame:
    """Class scores in `scores`, one per head."""
    rows = examples.withColumn("features", array_to_vector("embedding"))
    for number, model in enumerate(models):
        scored = model.copy()
        scored.setPredictionCol(f"_p{number}")
        scored.setProbabilityCol(f"_s{number}")
        scored.setRawPredictionCol(f"_r{number}")
        rows = scored.transform(rows)
    scores = F.array(*[vector_to_array(f"_s{n}")[1] for n in range(len(models))])
    extra = [f"_{kind}{n}" for n in range(len(models)) for kind in "psr"]
    return rows.withColumn("scores", scores).drop("features", *extra)


def metric_rows(spark: SparkSession, history: list[float], epoch: int = 0, first_step: int = 0) -> DataFrame:
    """Loss history as metric rows."""
    rows = [(epoch, first_step + s, float(v)) for s, v in enumerate(history)]
    return local_table(spark, rows, METRICS)


def labelled_embeddings(positives: DataFrame, negatives: DataFrame, embedding: Column) -> DataFrame:
    """Embeddings of both evaluation sets with their label; `embedding` turns a row into its final embedding."""
    rows = positives.withColumn("label", F.lit(1)).unionByName(negatives.withColumn("label", F.lit(0)))
    return rows.withColumn("embedding", embedding)


def evaluate(positives: DataFrame, negatives: DataFrame, score: Column, cut: float = 0.5) -> DataFrame:
    """Confusion counts of both sets; `score` is the positive-class score."""
    rows = positives.withColumn("label", F.lit(1)).unionByName(negatives.withColumn("label", F.lit(0)))
    return confusion_counts(rows.withColumn("predicted", (score > cut).cast("int")), "label", "predicted")
