"""Embeddings, projection, class scores and prediction lists."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from acoustic_spark.config import DetectConfig
from acoustic_spark.functions.arrow_lists import ARROW_TYPES, flat_lists, list_rows, matrix_lists, matrix_rows, regroup
from acoustic_spark.functions.model_cache import loaded
from acoustic_spark.functions.spectral import quantize
from acoustic_spark.functions.text import alert_flag
from acoustic_spark.operators.toplists import top_n_per_key
from acoustic_spark.workspace import shared_folder

# A model loader: called once per Python worker, gives a function from a matrix of
# inputs (one row each) to a matrix of outputs.
ModelLoader = Callable[[], Callable[[np.ndarray], np.ndarray]]

MAX_DICTIONARY_ROWS = 10_000
#: Cells of the projection in one block (8 MB), and rows multiplied with it at once.
BLOCK_CELLS, PROJECTED_ROWS = 1 << 20, 512


@dataclass(frozen=True)
class Projection:
    """Matrix (out, in) and mean (in) of the whitening step."""

    matrix: np.ndarray
    mean: np.ndarray


@dataclass(frozen=True)
class Dense:
    """One fully connected layer: weights (out, in), bias (out), activation."""

    weights: np.ndarray
    bias: np.ndarray
    activation: str = "sigmoid"

    def apply(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights.T + self.bias
        if self.activation == "sigmoid":
            return 1.0 / (1.0 + np.exp(-z))
        if self.activation == "relu":
            return np.maximum(z, 0.0)
        if self.activation == "none":
            return z
        raise ValueError(f"unknown activation {self.activation!r}")


# --- embeddings ---------------------------------------------------------------


def embed_rows(
    patch: Column, load_model: ModelLoader, width: int, batch_size: int = 256, value_type: str = "float"
) -> Column:
    """Embedding of each patch row with the given model."""
    predict = predict_batch_udf(
        load_model,
        return_type=T.ArrayType(T.DoubleType() if value_type == "double" else T.FloatType()),
        batch_size=batch_size,
        input_tensor_shapes=[[width]],
    )
    return predict(patch)


def embed_clips(patches: Column, load_model: ModelLoader, width: int, value_type: str = "float") -> Column:
    """Embeddings of all patches of each clip; one model call covers an Arrow batch of clips."""
    token = hashlib.sha256(cloudpickle.dumps(load_model)).hexdigest()

    @F.arrow_udf(f"array<array<{value_type}>>")
    def embed(column: pa.Array) -> pa.Array:
        model = loaded(token, load_model)
        inputs, sizes = matrix_rows(column, width)
        if not len(inputs):
            return pa.array([[] for _ in sizes], pa.list_(pa.list_(ARROW_TYPES[value_type])))
        return regroup(np.asarray(model(inputs)), sizes, ARROW_TYPES[value_type])

    return embed(patches)


def whiten(embedding: Column, projection: Projection) -> Column:
    """`matrix . (x - mean)` of each embedding row, one matrix product per Arrow batch."""
    width = projection.mean.size

    @F.arrow_udf("array<double>")
    def project(column: pa.Array) -> pa.Array:
        values = np.asarray(column.flatten(), dtype=np.float64)
        if values.size != len(column) * width:
            raise ValueError(f"expected embeddings of {width} values")
        return matrix_lists((values.reshape(-1, width) - projection.mean) @ projection.matrix.T, pa.float64())

    return project(embedding)


def whiten_clips(embeddings: Column, projection: Projection) -> Column:
    """The same for the list of embeddings of each clip."""

    @F.arrow_udf("array<array<double>>")
    def project(column: pa.Array) -> pa.Array:
        x, sizes = matrix_rows(column, projection.mean.size)
        return regroup((x - projection.mean) @ projection.matrix.T, sizes, pa.float64())

    return project(embeddings)


def whiten_rows(embeddings: DataFrame, key: str, pca: DataFrame, pca_mean: DataFrame) -> DataFrame:
    """The projection with its weights in tables, (o, i, w) and (i, m), of any size: (key, o, y).

    The matrix is cut into blocks of outputs, BLOCK_CELLS cells each, and every block is multiplied with the Arrow batches
    of the embeddings where they are: these are read once a block and never shuffled, and driver and tasks hold one block at a
    time. Cells that the tables lack are 0. Positions that an embedding lacks, or has as null, add nothing; empty embeddings give no rows.
    """
    cells = pca.join(pca_mean, "i").select("o", "i", "w", "m")
    width, first, last = cells.agg(F.max("i") + 1, F.min("o"), F.max("o")).first()
    types = {f.name: f.dataType.simpleString() for f in embeddings.schema}
    schema = f"`{key}` {types[key]}, o int, y double"
    if width is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = embeddings.select(key, F.col("embedding").cast("array<double>").alias("embedding")).where(F.size("embedding") > 0)

    def product(block: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            outputs, weights, mean = block.value
            for batch in batches:
                for at in range(0, batch.num_rows, PROJECTED_ROWS):
                    part = batch.slice(at, PROJECTED_ROWS)
                    x = np.zeros((part.num_rows, len(mean)))
                    for row, values in zip(x, part.column(1)):
                        given = values.values[: len(mean)]
                        known = np.asarray(given.is_valid())
                        row[: len(known)][known] = np.asarray(given.drop_null()) - mean[: len(known)][known]
                    y = x @ weights.T
                    keys = part.column(0).take(pa.array(np.repeat(np.arange(len(y)), len(outputs))))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(np.tile(outputs, len(y)), pa.int32()), pa.array(y.ravel())], [key, "o", "y"])

        return run

    out = None
    step = max(1, BLOCK_CELLS // width)
    for low in range(first, last + 1, step):
        block = cells.where(F.col("o").between(low, min(low + step - 1, last))).toArrow()
        if not block.num_rows:
            continue
        outputs, place = np.unique(block["o"].to_numpy(), return_inverse=True)
        weights, mean = np.zeros((len(outputs), width)), np.zeros(width)
        at = block["i"].to_numpy()
        weights[place, at] = block["w"].to_numpy()
        mean[at] = block["m"].to_numpy()
        held = embeddings.sparkSession.sparkContext.broadcast((outputs.astype(np.int32), weights, mean))
        part = rows.mapInArrow(product(held), schema)
        out = part if out is None else out.unionAll(part)
    return out


def quantize_array(values: Column) -> Column:
    return F.transform(values, quantize)


def dense(values: Column, *layers: Dense) -> Column:
    """Fully connected layers on each row's array."""
    width = layers[0].weights.shape[1]

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        x = np.asarray(column.flatten(), dtype=np.float64)
        if x.size != len(column) * width:
            raise ValueError(f"expected arrays of {width} values")
        x = x.reshape(-1, width)
        for layer in layers:
            x = layer.apply(x)
        return matrix_lists(x, pa.float64())

    return score(values)


# --- clip scores ----------------------------------------------------------------


def pool_clips(embeddings: Column, width: int, max_frames: int) -> Column:
    """Mean of the first `max_frames` embeddings of each clip; NULL for a clip with none."""

    @F.arrow_udf("array<double>")
    def pool(column: pa.Array) -> pa.Array:
        x, sizes = matrix_rows(column, width)
        ends = np.cumsum(sizes)
        means = [x[e - s : e][:max_frames].mean(axis=0) if s else x[:0, 0] for s, e in zip(sizes, ends)]
        return flat_lists(means, pa.float64())

    return F.when(F.size(embeddings) > 0, pool(embeddings))


def score_clips(embeddings: Column, head: Sequence[Dense], max_frames: int) -> Column:
    """Class scores of each clip: mean over the valid embeddings, then the layers.

    A clip without embeddings gets an empty score list.
    """
    width = head[0].weights.shape[1]

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        x, sizes = matrix_rows(column, width)
        rows = []
        for end, size in zip(np.cumsum(sizes), sizes):
            y = x[end - size : end][:max_frames].mean(axis=0) if size else None
            for layer in head if size else ():
                y = layer.apply(y)
            rows.append(y if size else np.empty(0))
        return flat_lists(rows, pa.float64())

    return score(embeddings)


def pool_rows(embeddings: DataFrame, keys: Sequence[str], position: str, max_frames: int) -> DataFrame:
    """Row form of the pooling: (keys, n_valid, embedding), partial means before the shuffle."""
    return (
        embeddings.filter(F.col(position) < max_frames)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).cast("int").alias("n_valid"),
            Summarizer.mean(array_to_vector("embedding")).alias("_mean"),
        )
        .select(*keys, "n_valid", vector_to_array("_mean").alias("embedding"))
    )


def score_rows(scores: Column) -> Column:
    """Generator of (class_id, score) from a score array."""
    return F.posexplode(scores).alias("class_id", "score")


# --- prediction lists -------------------------------------------------------------


def top_scores(scores: DataFrame, keys: Sequence[str], cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Row form: the top classes of each clip above the score limit, ranked.

    Ties at the cut go to the smaller class id. The limit is strict, so filtering
    first gives the same rows as cutting first.
    """
    above = scores.filter(F.col("score") > cfg.min_score)
    return top_n_per_key(above, keys, [F.desc("score"), F.asc("class_id")], cfg.max_predictions)


def name_classes(scores: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their display name, and the rows of unknown classes."""
    named = scores.join(classes.select("class_id", "display_name"), "class_id", "left").withColumnRenamed("display_name", "label")
    return named.filter(F.col("label").isNotNull()), named.filter(F.col("label").isNull()).drop("label")


def prediction_lists(named: DataFrame, keys: Sequence[str], cfg: DetectConfig = DetectConfig(), *carried: Column) -> DataFrame:
    """One row per clip with its sorted prediction list and alert flag.

    Expects one row per (clip, class), so a group is no larger than the class
    dictionary. A clip with no class above the limit keeps an empty list.
    """
    item = F.struct(
        (-F.col("score")).alias("order"), F.col("class_id"), F.col("label"), F.col("score")
    )
    ranked = F.slice(
        F.array_sort(F.collect_list(F.when(F.col("score") > cfg.min_score, item))), 1, cfg.max_predictions
    )
    lists = named.groupBy(*keys).agg(ranked.alias("_ranked"), *carried)
    predictions = F.transform("_ranked", lambda p: F.struct(p["label"].alias("label"), p["score"].alias("score")))
    return (
        lists.withColumn("predictions", predictions)
        .withColumn("flag", alert_flag(F.col("_ranked.label"), cfg.alert_patterns))
        .drop("_ranked")
    )


def top_items(scores: Column, cfg: DetectConfig) -> Column:
    """The kept (order, class_id, score) of a score array, best first; ties go to the smaller class id."""
    items = F.transform(scores, lambda s, i: F.struct((-s).alias("order"), i.alias("class_id"), s.alias("score")))
    return F.slice(F.array_sort(F.filter(items, lambda p: p["score"] > cfg.min_score)), 1, cfg.max_predictions)


def rank_array(scores: Column, names: Column, cfg: DetectConfig) -> Column:
    """Array form: prediction list of a score array, names looked up by class id in a map."""

    def named(p: Column) -> Column:
        label = F.coalesce(
            F.element_at(names, p["class_id"]),
            F.raise_error(F.concat(F.lit("unknown class "), p["class_id"].cast("string"))).cast("string"),
        )
        return F.struct(label.alias("label"), p["score"].alias("score"))

    return F.transform(top_items(scores, cfg), named)


def rank_known(scores: Column, names: Column, cfg: DetectConfig) -> tuple[Column, Column]:
    """Like `rank_array`, but kept classes without a name end nothing: the list of the named ones, and the ids of the others.

    The others use up places of the list, as a name does not change what is ranked.
    """
    named = F.transform(
        top_items(scores, cfg), lambda p: F.struct(F.element_at(names, p["class_id"]).alias("label"), p["score"].alias("score"), p["class_id"].alias("class_id"))
    )
    return known_items(named), unknown_items(named)


def known_items(named: Column) -> Column:
    """(label, score) of the items that have a label."""
    return F.transform(F.filter(named, lambda p: p["label"].isNotNull()), lambda p: F.struct(p["label"].alias("label"), p["score"].alias("score")))


def unknown_items(named: Column) -> Column:
    """Class ids of the items without a label, best score first."""
    return F.transform(F.filter(named, lambda p: p["label"].isNull()), lambda p: p["class_id"])


def unknown_rows(detections: DataFrame, *keys: str) -> DataFrame:
    """Rejects of a detection: (keys, class_id, reason), one row for each kept class without a name."""
    return detections.select(*keys, F.explode("unknown_classes").alias("class_id"), F.lit("unknown class").alias("reason"))


def name_lists(clips: DataFrame, scores: str, classes: DataFrame, cfg: DetectConfig) -> DataFrame:
    """Clips with `predictions` and `unknown_classes` in place of the score arrays, for a dictionary of any size.

    A clip without scores above the limit has two empty lists; kept classes without a name are in the second.
    Ranked first: only the kept ids, max_predictions a clip, are looked up, by a join, and put together again by clip. The
    clips are written between, so that each is computed once and keeps its number.
    """
    spark, folder = clips.sparkSession, shared_folder(clips.sparkSession, "ranked")
    ranked = clips.withColumns({"_top": top_items(F.col(scores), cfg), "_row": F.monotonically_increasing_id()}).drop(scores)
    ranked.write.parquet(folder)
    rows = spark.read.schema(ranked.schema).parquet(folder)
    kept = rows.select("_row", F.posexplode("_top").alias("pos", "top")).select("_row", "pos", "top.class_id", "top.score")
    named = kept.join(classes.select("class_id", "display_name"), "class_id", "left")
    item = F.struct("pos", F.col("display_name").alias("label"), "score", "class_id")
    lists = named.groupBy("_row").agg(F.array_sort(F.collect_list(item)).alias("_list"))
    found = rows.join(lists, "_row", "left").withColumn("_list", F.coalesce("_list", F.array().cast(lists.schema["_list"].dataType)))
    return found.withColumns({"predictions": known_items(F.col("_list")), "unknown_classes": unknown_items(F.col("_list"))}).drop("_top", "_row", "_list")


def sorted_predictions(predictions: Column) -> Column:
    """Prediction list by descending score."""
    keyed = F.transform(predictions, lambda p: F.struct((-p["score"]).alias("order"), p["label"].alias("label")))
    return F.transform(
        F.array_sort(keyed), lambda p: F.struct(p["label"].alias("label"), (-p["order"]).alias("score"))
    )
