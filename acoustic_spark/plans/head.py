"""The two-class head: a hidden layer and one independent logistic output per class, fitted by Adam.

Every step takes the gradient over all examples. Tasks add up the gradients of their
rows, so what a step moves is one array of the weights' size for each task, however many examples there are. The optimiser's
state is saved with the weights after every epoch, so a resumed fit goes on exactly as an uninterrupted one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.operators.scoring import Dense
from acoustic_spark.schemas import METRICS
from acoustic_spark.workspace import shared_folder

# Groups of tasks whose sums are added up before they come to the driver.
GROUPS = 16
SAVED = "epoch int, first_step long, losses array<double>, weights array<double>, m array<double>, v array<double>"


@dataclass(frozen=True)
class HeadConfig:
    """Size of the hidden layer, outputs, optimiser and steps per epoch; the optimiser's fixed values are the usual ones."""

    hidden: int = 100
    classes: int = 2
    steps: int = 10
    learning_rate: float = 1e-4
    epsilon: float = 1e-8
    decay: tuple[float, float] = (0.9, 0.999)
    seed: int = 0


@dataclass
class Head:
    """Weights as one flat array (hidden weights, hidden bias, output weights, output bias), the optimiser's moments and steps done."""

    width: int
    cfg: HeadConfig
    weights: np.ndarray
    m: np.ndarray
    v: np.ndarray
    step: int = 0

    @classmethod
    def start(cls, width: int, cfg: HeadConfig) -> Head:
        """Weights spread over the usual range of a layer by a fixed rule, biases 0."""
        sizes = width * cfg.hidden, cfg.hidden * cfg.classes
        numbers = np.sin((cfg.seed + np.arange(1.0, sum(sizes) + 1)) ** 2)
        first = numbers[: sizes[0]] * np.sqrt(6 / (width + cfg.hidden))
        second = numbers[sizes[0] :] * np.sqrt(6 / (cfg.hidden + cfg.classes))
        weights = np.concatenate([first, np.zeros(cfg.hidden), second, np.zeros(cfg.classes)])
        return cls(width, cfg, weights, np.zeros_like(weights), np.zeros_like(weights))

    def parts(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        h, k = self.cfg.hidden, self.cfg.classes
        ends = np.cumsum([self.width * h, h, h * k])
        first, bias, second, last = np.split(flat, ends)
        return first.reshape(self.width, h), bias, second.reshape(h, k), last

    def layers(self) -> list[Dense]:
        """The layers for `scoring.dense` and `Classifier.head`."""
        first, bias, second, last = self.parts(self.weights)
        return [Dense(first.T, bias, "relu"), Dense(second.T, last, "sigmoid")]

    def sums(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Summed loss, number of outputs, and summed gradient of some examples."""
        first, bias, second, last = self.parts(self.weights)
        hidden = np.maximum(x @ first + bias, 0.0)
        z = hidden @ second + last
        loss = (np.maximum(z, 0.0) - z * labels + np.log1p(np.exp(-np.abs(z)))).sum()
        dz = 0.5 * (1.0 + np.tanh(z / 2)) - labels
        dh = (dz @ second.T) * (hidden > 0)
        return np.concatenate([[loss, z.size], (x.T @ dh).ravel(), dh.sum(axis=0), (hidden.T @ dz).ravel(), dz.sum(axis=0)])

    def update(self, gradient: np.ndarray) -> None:
        """One step of Adam."""
        one, two = self.cfg.decay
        self.step += 1
        self.m = one * self.m + (1 - one) * gradient
        self.v = two * self.v + (1 - two) * gradient**2
        rate = self.cfg.learning_rate * np.sqrt(1 - two**self.step) / (1 - one**self.step)
        self.weights = self.weights - rate * self.m / (np.sqrt(self.v) + self.cfg.epsilon)


def gradient(examples: DataFrame, head: Head) -> tuple[float, np.ndarray]:
    """Mean loss and its gradient over all rows of (embedding, labels)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x, y = (batch[c].flatten().to_numpy().reshape(batch.num_rows, -1).astype(np.float64) for c in ("embedding", "labels"))
                part = head.sums(x, y)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["sums"])

    def added(group: pa.Table) -> pa.Table:
        sums = group["sums"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"sums": pa.array([sums], pa.list_(pa.float64()))})

    tasks = examples.select("embedding", "labels").mapInArrow(run, "sums array<double>").withColumn("slot", F.spark_partition_id() % GROUPS)
    rows = tasks.groupBy("slot").applyInArrow(added, "sums array<double>").collect()
    loss, n, *slopes = np.sum([r["sums"] for r in rows], axis=0)
    return loss / n, np.array(slopes) / n


def last_epoch(spark: SparkSession, folder: str) -> int | None:
    """The newest epoch that was saved whole."""
    try:
        return spark.read.schema(SAVED).parquet(f"{folder}/epochs/*").agg(F.max("epoch")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_head(spark: SparkSession, folder: str, epoch: int, width: int, cfg: HeadConfig) -> Head:
    row = spark.read.schema(SAVED).parquet(f"{folder}/epochs/{epoch}").first()
    arrays = (np.array(row[c]) for c in ("weights", "m", "v"))
    return Head(width, cfg, *arrays, row["first_step"] + len(row["losses"]))


def fit_head(examples: DataFrame, folder: str, epochs: int, cfg: HeadConfig = HeadConfig()) -> Head:
    """Fit the head on (embedding, labels), saving after every epoch and going on from the newest saved one.

    An epoch is one row in a folder of its own, written at once: an interrupted run
    leaves whole epochs only, and a repeated epoch replaces itself. Rows without an embedding or labels take no part.
    Without any other there is nothing to fit, which is an error.
    """
    spark = examples.sparkSession
    rows = examples.where("embedding IS NOT NULL AND labels IS NOT NULL")
    one = rows.select(F.size("embedding")).first()
    if one is None:
        raise ValueError("no examples")
    done = last_epoch(spark, folder)
    head = Head.start(one[0], cfg) if done is None else load_head(spark, folder, done, one[0], cfg)
    left = range(0 if done is None else done + 1, epochs)
    if left:  # every step reads the examples, so they are made once
        copy = shared_folder(spark, "examples")
        rows.select("embedding", "labels").write.parquet(copy)
        rows = spark.read.parquet(copy)
    for epoch in left:
        first, losses = head.step, []
        for _ in range(cfg.steps):
            loss, slope = gradient(rows, head)
            losses.append(float(loss))
            head.update(slope)
        saved = [(epoch, first, losses, head.weights.tolist(), head.m.tolist(), head.v.tolist())]
        spark.createDataFrame(saved, SAVED).coalesce(1).write.mode("overwrite").parquet(f"{folder}/epochs/{epoch}")
    return head


def loss_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(epoch, step, loss) of every saved step; a loss is that before the step."""
    saved = spark.read.schema(SAVED).parquet(f"{folder}/epochs/*").select("epoch", "first_step", F.posexplode("losses").alias("at", "loss"))
    return saved.select("epoch", (F.col("first_step") + F.col("at")).alias("step"), "loss").to(METRICS)


def fit_sql(examples: str, width: int, cfg: HeadConfig, steps: int) -> str:
    """SQL tables of the same fit, to compare with: p0 .. p{steps} (kind, a, b, w, m, v), z0 .. z{steps} (id, c, t, z) and loss0 .. loss{steps}.

    `examples` is SQL of x (id, i, v) and y (id, c, t).
    """
    h, k = cfg.hidden, cfg.classes
    one, two = cfg.decay
    tables = [examples]
    tables.append(f"""p0 AS MATERIALIZED (
  SELECT 'w1' AS kind, i AS a, j AS b, sqrt(6.0 / {width + h}) * sin(pow({cfg.seed} + i * {h} + j + 1, 2)) AS w, 0.0::DOUBLE AS m, 0.0::DOUBLE AS v FROM range({width}) r(i), range({h}) s(j)
  UNION ALL SELECT 'w2', j, c, sqrt(6.0 / {h + k}) * sin(pow({cfg.seed} + {width * h} + j * {k} + c + 1, 2)), 0.0, 0.0 FROM range({h}) r(j), range({k}) s(c)
  UNION ALL SELECT 'b1', 0, j, 0.0, 0.0, 0.0 FROM range({h}) r(j) UNION ALL SELECT 'b2', 0, c, 0.0, 0.0, 0.0 FROM range({k}) r(c))""")
    for t in range(steps + 1):
        tables.append(f"""h{t} AS MATERIALIZED (
  SELECT id, j, greatest(0.0, s + w) AS h FROM (SELECT id, b AS j, sum(v * w) AS s FROM x JOIN (SELECT a, b, w FROM p{t} WHERE kind = 'w1') ON i = a GROUP BY ALL)
  JOIN (SELECT b, w FROM p{t} WHERE kind = 'b1') ON b = j)""")
        tables.append(f"""z{t} AS MATERIALIZED (
  SELECT id, c, t, s + w AS z FROM (SELECT id, b AS c, sum(h * w) AS s FROM h{t} JOIN (SELECT a, b, w FROM p{t} WHERE kind = 'w2') ON j = a GROUP BY ALL)
  JOIN (SELECT b, w FROM p{t} WHERE kind = 'b2') ON b = c JOIN y USING (id, c))""")
        tables.append(f"loss{t} AS (SELECT avg(greatest(z, 0.0) - z * t + ln(1 + exp(-abs(z)))) AS loss FROM z{t})")
        if t < steps:
            rate = f"{cfg.learning_rate} * sqrt(1 - pow({two}, {t + 1})) / (1 - pow({one}, {t + 1}))"
            tables.append(f"""dz{t} AS MATERIALIZED (SELECT id, c, (1 / (1 + exp(-z)) - t) / (SELECT count(*) FROM z{t}) AS d FROM z{t})""")
            tables.append(f"""dh{t} AS MATERIALIZED (
  SELECT id, j, sum(d * w) AS d FROM dz{t} JOIN (SELECT a, b, w FROM p{t} WHERE kind = 'w2') ON b = c JOIN h{t} USING (id) WHERE j = a AND h > 0 GROUP BY ALL)""")
            tables.append(f"""g{t} AS MATERIALIZED (
  SELECT 'w1' AS kind, i AS a, j AS b, sum(v * d) AS g FROM x JOIN dh{t} USING (id) GROUP BY ALL
  UNION ALL SELECT 'b1', 0, j, sum(d) FROM dh{t} GROUP BY ALL
  UNION ALL SELECT 'w2', j, c, sum(h * d) FROM h{t} JOIN dz{t} USING (id) GROUP BY ALL UNION ALL SELECT 'b2', 0, c, sum(d) FROM dz{t} GROUP BY ALL)""")
            tables.append(f"""p{t + 1} AS MATERIALIZED (
  SELECT kind, a, b, w - {rate} * m / (sqrt(v) + {cfg.epsilon}) AS w, m, v FROM (
    SELECT kind, a, b, w, {one} * m + (1 - {one}) * coalesce(g, 0) AS m, {two} * v + (1 - {two}) * pow(coalesce(g, 0), 2) AS v
    FROM p{t} LEFT JOIN g{t} USING (kind, a, b)))""")
    return ", ".join(tables)
