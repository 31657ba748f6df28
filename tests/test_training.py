"""Head fitting, saving and resuming, evaluation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from acoustic_spark.operators.pairing import concatenate, shuffle_rows, with_any_label
from acoustic_spark.operators import scoring
from acoustic_spark.plans import head, training


@pytest.fixture(scope="module")
def examples(spark):
    """Two separable clouds."""
    rng = np.random.default_rng(2)
    make = lambda sign, first: spark.createDataFrame(
        [(first + i, [float(v) for v in rng.normal(sign, 0.5, 3)]) for i in range(40)], "id BIGINT, embedding ARRAY<DOUBLE>"
    )
    return concatenate(make(1.0, 0), make(-1.0, 100)).cache()


def test_logistic_heads(spark, examples):
    heads = training.fit_logistic_heads(examples)
    scored = training.apply_logistic_heads(examples, heads)
    assert "features" not in scored.columns
    right = (F.col("scores")[0] > F.col("scores")[1]).cast("int") == F.col("labels")[0]
    assert scored.filter(right).count() >= 78
    losses = training.metric_rows(spark, list(heads[0].summary.objectiveHistory)).orderBy("step").collect()
    assert losses[-1].loss < losses[0].loss


def plain_fit(x, y, cfg, steps):
    """Losses of the fit with slopes from differences of the loss."""
    fitted, losses = head.Head.start(x.shape[1], cfg), []
    for _ in range(steps):
        at = fitted.weights

        def loss(weights, fitted=fitted):
            first, bias, second, last = fitted.parts(weights)
            z = np.maximum(x @ first + bias, 0) @ second + last
            p = 1 / (1 + np.exp(-z))
            return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

        losses.append(loss(at))
        slope = np.array([(loss(at + d) - loss(at - d)) / 2e-6 for d in np.eye(len(at)) * 1e-6])
        fitted.update(slope)
    return losses, fitted


def test_head_equals_plain_fit(spark, examples, tmp_path):
    cfg = head.HeadConfig(hidden=3, steps=4, learning_rate=0.05, seed=1)
    rows = examples.select("id", "embedding", "labels").collect()
    x, y = np.array([r.embedding for r in rows]), np.array([r.labels for r in rows], float)
    losses, plain = plain_fit(x, y, cfg, 8)
    fitted = head.fit_head(examples.repartition(5), str(tmp_path / "head"), 2, cfg)
    found = head.loss_rows(spark, str(tmp_path / "head")).orderBy("step").collect()
    assert [(r.epoch, r.step) for r in found] == [(s // 4, s) for s in range(8)]
    assert np.allclose([r.loss for r in found], losses, atol=1e-6) and np.allclose(fitted.weights, plain.weights, atol=1e-3)
    scored = examples.withColumn("scores", scoring.dense(F.col("embedding"), *fitted.layers()))
    right = (F.col("scores")[0] > F.col("scores")[1]).cast("int") == F.col("labels")[0]
    more = head.fit_head(examples, str(tmp_path / "head"), 12, cfg)
    assert more.step == 48 and scored.count() == 80
    scored = examples.withColumn("scores", scoring.dense(F.col("embedding"), *more.layers()))
    assert scored.filter(right).count() >= 78
    # The outputs are independent: they need not add up to one.
    assert scored.filter(F.abs(F.col("scores")[0] + F.col("scores")[1] - 1) > 1e-6).count()


def test_resumed_fit_is_the_uninterrupted_one(spark, examples, tmp_path):
    cfg = head.HeadConfig(hidden=4, steps=3, learning_rate=0.02)
    assert head.last_epoch(spark, str(tmp_path / "none")) is None
    whole = head.fit_head(examples, str(tmp_path / "whole"), 3, cfg)
    parts = str(tmp_path / "parts")
    for epochs in (1, 1, 3):
        resumed = head.fit_head(examples, parts, epochs, cfg)
    assert head.last_epoch(spark, parts) == 2 and resumed.step == whole.step == 9
    assert np.allclose(resumed.weights, whole.weights, atol=1e-12) and np.allclose(resumed.v, whole.v, atol=1e-12)


def test_head_without_examples(spark, examples, tmp_path):
    with pytest.raises(ValueError, match="no examples"):
        head.fit_head(examples.where("embedding IS NULL"), str(tmp_path), 1)


def test_evaluate(spark):
    rows = lambda *scores: spark.createDataFrame([(float(s),) for s in scores], "score DOUBLE")
    counts = training.evaluate(rows(0.9, 0.6, 0.5), rows(0.1, 0.7), F.col("score"))
    assert sorted(map(tuple, counts.collect())) == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 2)]


def test_shuffle_and_labels(spark):
    rows = spark.range(200)
    order = [r.id for r in shuffle_rows(rows, 1, "id").collect()]
    assert order == [r.id for r in shuffle_rows(rows, 1, "id").collect()] and order != sorted(order)
    assert order != [r.id for r in shuffle_rows(rows, 2, "id").collect()] and sorted(order) == list(range(200))
    meta = spark.createDataFrame([(1, ["Cap Gun", "Speech"]), (2, ["Music"])], "id INT, labels ARRAY<STRING>")
    assert [r.id for r in with_any_label(meta, F.col("labels"), ("Gunshot", "Cap Gun")).collect()] == [1]
