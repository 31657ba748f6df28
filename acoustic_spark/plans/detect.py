"""Clip table to detections, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from acoustic_spark.config import FULL_SCALE, DetectConfig
from acoustic_spark.functions.text import alert_flag
from acoustic_spark.operators.resample import mono_signal
from acoustic_spark.operators.scoring import (
    MAX_DICTIONARY_ROWS,
    Dense,
    ModelLoader,
    Projection,
    embed_clips,
    name_lists,
    rank_known,
    score_clips,
    whiten_clips,
)
from acoustic_spark.operators.spectrum import patches


@dataclass(frozen=True)
class Classifier:
    """What the user brings: the patch model, the projection, the head and the class names."""

    load_model: ModelLoader
    projection: Projection
    head: Sequence[Dense]
    classes: DataFrame


def dictionary_map(classes: DataFrame) -> Column | None:
    """Class names as one map literal; None for a dictionary of more than MAX_DICTIONARY_ROWS."""
    rows = classes.select("class_id", "display_name").limit(MAX_DICTIONARY_ROWS + 1).collect()
    if len(rows) > MAX_DICTIONARY_ROWS:
        return None
    return F.create_map(*[F.lit(v) for r in rows for v in (r["class_id"], r["display_name"])])


def require_int16(clips: DataFrame, samples: str = "samples") -> DataFrame:
    """The sample column must be an int16 array; checked before anything runs."""
    found = clips.schema[samples].dataType
    if found != T.ArrayType(T.ShortType(), found.containsNull if isinstance(found, T.ArrayType) else True):
        raise TypeError(f"bad sample type: {found.simpleString()}")
    return clips


def detect(classifier: Classifier, cfg: DetectConfig = DetectConfig(), kernel: str = "sinc") -> Callable[[DataFrame], DataFrame]:
    """Classifier for `clips.transform(detect(...))`.

    Every step is row by row, so a clip is read, classified and flagged in one
    task; nothing is shuffled and the patches never return to the JVM. The columns
    are built once and serve every micro-batch. With a dictionary too large for a literal the kept class ids are looked up by a
    join instead (`name_lists`), with equal results; a stream then calls it for each micro-batch. A kept class that the
    dictionary does not name ends nothing: it is left out of `predictions` and given back in `unknown_classes` (`unknown_rows` lists them).
    """
    features = cfg.features
    names = dictionary_map(classifier.classes)
    signal = mono_signal(
        F.col("samples"), F.col("n_channels"), F.col("sample_rate"), features.sample_rate, kernel
    )
    # Mixing and resampling are linear, so full scale is divided out after them.
    cut = patches(signal, features, scale=FULL_SCALE)
    embedded = embed_clips(cut, classifier.load_model, features.patch_frames * features.bands, features.value_type)
    whitened = whiten_clips(embedded, classifier.projection)
    scores = score_clips(whitened, classifier.head, cfg.max_frames)
    lists = None if names is None else dict(zip(("predictions", "unknown_classes"), rank_known(F.col("_scores"), names, cfg)))
    flag = alert_flag(F.col("predictions.label"), cfg.alert_patterns)

    def run(clips: DataFrame) -> DataFrame:
        scored = require_int16(clips).withColumn("_scores", scores).drop("samples")
        if lists is None:
            return name_lists(scored, "_scores", classifier.classes, cfg).withColumn("flag", flag)
        return scored.withColumns(lists).withColumn("flag", flag).drop("_scores")

    return run


def detect_clips(clips: DataFrame, classifier: Classifier, cfg: DetectConfig = DetectConfig()) -> DataFrame:
    """Prediction list, alert flag and unknown classes of every clip."""
    return clips.transform(detect(classifier, cfg))
