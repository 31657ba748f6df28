"""Queries on embeddings, scores and whole-clip detection."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acoustic_spark.config import DetectConfig, FeatureConfig
from acoustic_spark.operators import scoring
from acoustic_spark.operators.positions import first_n
from acoustic_spark.operators.quality import embedding_statistics, mean_cross_entropy
from acoustic_spark.operators.scoring import Dense, Projection
from acoustic_spark.plans.detect import Classifier, detect
from acoustic_spark.plans.queries_features import PATCHES, arrow_patches, big, mel_sql
from acoustic_spark.plans.registry import query
from acoustic_spark.plans.tables import CLASSES, SERIES, SMALL, classes, clip_rows, clips, read
from acoustic_spark.sources.dimensions import load_projection, read_projection
from acoustic_spark.workspace import shared_folder

# --- a fixed formula in place of trained weights -----------------------------------------


def formula_weights(outputs: int, inputs: int) -> np.ndarray:
    """Weight (o, i) = cos((o + 1) * (i + 1)) / inputs."""
    return np.cos(np.outer(np.arange(1, outputs + 1), np.arange(1, inputs + 1))) / inputs


def formula_model(outputs: int, inputs: int):
    """Loader of a linear model with the formula weights."""

    def load():
        weights = formula_weights(outputs, inputs)
        return lambda x: np.asarray(x, dtype=np.float64) @ weights.T

    return load


CELLS = SMALL.patch_frames * SMALL.bands
EMBED_DIM = 6


@query(
    "patch_embeddings",
    f"""WITH {PATCHES}
SELECT sensor_id, CAST(example AS BIGINT) AS example, CAST(o AS BIGINT) AS o,
       round(sum(v * cos((o + 1) * (frame * {SMALL.bands} + band + 1)) / {CELLS}), 6) AS y
FROM patches, range({EMBED_DIM}) AS os(o) GROUP BY ALL""",
)
def patch_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """A model applied to every patch in batches."""
    embedded = scoring.embed_rows(F.col("patch"), formula_model(EMBED_DIM, CELLS), CELLS, value_type="double")
    rows = arrow_patches(spark, sf).select("sensor_id", "example", F.posexplode(embedded).alias("o", "y"))
    return rows.select("sensor_id", *big("example", "o"), F.round("y", 6).alias("y"))


# --- projection from the embeddings table --------------------------------------------------


def label_means(spark: SparkSession, sf: str) -> DataFrame:
    """Mean embedding of each label: (o, i, w)."""
    means = read(spark, sf, "embeddings").groupBy("label").agg(Summarizer.mean(array_to_vector("embedding")).alias("m"))
    return means.select(F.col("label").alias("o"), F.posexplode(vector_to_array("m")).alias("i", "w"))


def overall_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean embedding of the table: (i, m)."""
    mean = read(spark, sf, "embeddings").agg(Summarizer.mean(array_to_vector("embedding")).alias("m"))
    return mean.select(F.posexplode(vector_to_array("m")).alias("i", "m"))


LABELS, DIM = 10, 64

PROJECTION = """cells AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
pca AS (SELECT label AS o, i, avg(x) AS w FROM cells GROUP BY ALL),
pca_mean AS (SELECT i, avg(x) AS m FROM cells GROUP BY ALL),
whitened AS (
  SELECT vec_id, label, o, sum(w * (x - m)) AS y FROM cells JOIN pca USING (i) JOIN pca_mean USING (i) GROUP BY ALL)"""


def projection(spark: SparkSession, sf: str) -> Projection:
    return load_projection(label_means(spark, sf), overall_mean(spark, sf), LABELS, DIM)


@query(
    "projection_tables",
    f"""WITH {PROJECTION}
SELECT CAST(o AS BIGINT) AS o, CAST(i AS BIGINT) AS i, round(w, 6) AS w, round(m, 6) AS m FROM pca JOIN pca_mean USING (i)""",
)
def projection_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Matrix and mean written as tables, loaded with the shape check and shown as read."""
    folder = shared_folder(spark, "projection")
    label_means(spark, sf).write.parquet(f"{folder}/pca")
    overall_mean(spark, sf).write.parquet(f"{folder}/pca_mean")
    read_projection(spark, f"{folder}/pca", f"{folder}/pca_mean", LABELS, DIM)
    tables = spark.read.parquet(f"{folder}/pca").join(spark.read.parquet(f"{folder}/pca_mean"), "i")
    return tables.select(*big("o", "i"), F.round("w", 6).alias("w"), F.round("m", 6).alias("m"))


WHITENED = f"WITH {PROJECTION} SELECT vec_id, CAST(o AS BIGINT) AS o, round(y, 6) AS y FROM whitened"


@query("whitened_embeddings", WHITENED)
def whitened_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    y = scoring.whiten(F.col("embedding"), projection(spark, sf))
    return read(spark, sf, "embeddings").select("vec_id", F.posexplode(y).alias("o", "y")).select(
        "vec_id", *big("o"), F.round("y", 6).alias("y")
    )


@query("whitened_embeddings_join", WHITENED)
def whitened_embeddings_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.whiten_rows(
        read(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", label_means(spark, sf), overall_mean(spark, sf)
    )
    return rows.select("vec_id", *big("o"), F.round("y", 6).alias("y"))


# The projected values are small; the factor spreads them over the quantiser's range.
SPREAD = 20.0


def quantised_column(spark: SparkSession, sf: str) -> Column:
    y = scoring.whiten(F.col("embedding"), projection(spark, sf))
    return scoring.quantize_array(F.transform(y, lambda v: v * SPREAD))


def quantised(spark: SparkSession, sf: str) -> DataFrame:
    rows = read(spark, sf, "embeddings")
    return rows.select("vec_id", F.posexplode(quantised_column(spark, sf)).alias("o", "q"))


QUANTISED = f"""{PROJECTION}, quantised AS (
  SELECT vec_id, o, CAST(floor((greatest(-2.0, least(2.0, y * {SPREAD})) + 2.0) * 63.75) AS BIGINT) AS q FROM whitened)"""


@query("quantised_embeddings", f"WITH {QUANTISED} SELECT vec_id, CAST(o AS BIGINT) AS o, q FROM quantised")
def quantised_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return quantised(spark, sf).select("vec_id", *big("o", "q"))


@query(
    "embedding_statistics",
    f"""WITH {QUANTISED}
SELECT round(avg(q), 6) AS mean, round(stddev_pop(q), 6) AS std,
       CAST(abs(avg(q) - 123) <= 12.3 AND abs(stddev_pop(q) - 75) <= 7.5 AS BIGINT) AS ok FROM quantised""",
)
def quantised_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_statistics(quantised(spark, sf), "q").select(
        F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), *big("ok")
    )


# --- class scores ---------------------------------------------------------------------------


def label_head(spark: SparkSession, sf: str) -> Dense:
    """One logistic output per label, weighted by the label's mean embedding."""
    return Dense(projection(spark, sf).matrix, np.zeros(LABELS))


@query(
    "dense_scores",
    f"""WITH {PROJECTION}
SELECT vec_id, CAST(o AS BIGINT) AS class_id, round(1 / (1 + exp(-sum(w * x))), 6) AS score
FROM cells JOIN pca USING (i) GROUP BY vec_id, o""",
)
def dense_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = scoring.dense(F.col("embedding"), label_head(spark, sf))
    return read(spark, sf, "embeddings").select("vec_id", F.posexplode(scores).alias("class_id", "score")).select(
        "vec_id", *big("class_id"), F.round("score", 6).alias("score")
    )


MAX_FRAMES = 30


@query(
    "clip_scores",
    f"""WITH {PROJECTION}, kept AS (
  SELECT vec_id, label FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= {MAX_FRAMES}),
pooled AS (SELECT c.label AS clip, i, avg(x) AS x, count(*) AS n_valid FROM cells c JOIN kept k ON c.vec_id = k.vec_id GROUP BY ALL)
SELECT CAST(clip AS BIGINT) AS clip, CAST(n_valid AS BIGINT) AS n_valid, CAST(o AS BIGINT) AS class_id,
       round(1 / (1 + exp(-sum(w * x))), 6) AS score
FROM pooled JOIN pca USING (i) GROUP BY clip, n_valid, o""",
)
def clip_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Class scores of clips whose embeddings lie in separate rows; a clip is one label here."""
    rows = read(spark, sf, "embeddings").withColumnRenamed("label", "clip")
    placed = first_n(rows, ["clip"], "vec_id", MAX_FRAMES, "example", "_n")
    pooled = scoring.pool_rows(placed, ["clip"], "example", MAX_FRAMES)
    scores = scoring.dense(F.col("embedding"), label_head(spark, sf))
    return pooled.select("clip", "n_valid", F.posexplode(scores).alias("class_id", "score")).select(
        *big("clip", "n_valid", "class_id"), F.round("score", 6).alias("score")
    )


@query(
    "cross_entropy",
    """SELECT round(avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))), 6) AS loss
FROM (SELECT value / 50 - 1 AS z, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y FROM events)""",
)
def cross_entropy(spark: SparkSession, sf: str) -> DataFrame:
    logit, label = F.col("value") / 50 - 1, (F.col("event_type") == "error").cast("int")
    return mean_cross_entropy(read(spark, sf, "events"), logit, label).select(F.round("loss", 6).alias("loss"))


# --- whole clips ------------------------------------------------------------------------------

DETECT_FEATURES = FeatureConfig(
    sample_rate=6_000, window=16, hop=8, bands=4, lower_hz=125.0, upper_hz=2_900.0, patch_frames=2, value_type="double"
)
DETECT = DetectConfig(features=DETECT_FEATURES, max_predictions=3, min_score=0.45, max_frames=2, alert_patterns=("err", "purch"))
DETECT_CLIP = 48
DETECT_CELLS = DETECT_FEATURES.patch_frames * DETECT_FEATURES.bands


def classifier(spark: SparkSession, sf: str) -> Classifier:
    """Model, projection and head from the fixed formula; the classes come from the events."""
    dictionary = classes(spark, sf)
    n_classes = dictionary.count()
    project = Projection(formula_weights(EMBED_DIM, EMBED_DIM) * EMBED_DIM, np.arange(EMBED_DIM) / 10.0)
    head = [Dense(formula_weights(n_classes, EMBED_DIM) * EMBED_DIM, np.zeros(n_classes))]
    return Classifier(formula_model(EMBED_DIM, DETECT_CELLS), project, head, dictionary)


def detected(rows: DataFrame) -> DataFrame:
    """One row per clip and prediction; a clip without predictions keeps one row."""
    return rows.select(
        "sensor_id", "seq", *big("flag"), F.posexplode_outer("predictions").alias("pos", "p")
    ).select(
        "sensor_id",
        "seq",
        "flag",
        F.coalesce(F.col("pos") + 1, F.lit(0)).cast("bigint").alias("rank"),
        F.coalesce("p.label", F.lit("")).alias("label"),
        F.coalesce(F.round("p.score", 6), F.lit(0.0)).alias("score"),
    )


_F = DETECT_FEATURES
DETECTED = f"""WITH {SERIES}, {clip_rows(DETECT_CLIP)}, {CLASSES}, {mel_sql(_F)},
clip_list AS (SELECT sensor_id, clip_no, min(event_id) AS seq FROM clip_rows GROUP BY ALL),
spread AS (
  SELECT sensor_id, clip_no, s / 32768.0::DOUBLE AS s, pos, n_samples * 3 // 4 AS m,
         unnest(range(greatest(0, CAST(floor((pos - 1) * 3 / 4.0) AS BIGINT) + 1),
                      least(CAST(ceil((pos + 1) * 3 / 4.0) AS BIGINT), n_samples * 3 // 4))) AS j
  FROM clip_rows),
signal AS (SELECT sensor_id, clip_no, m, j, sum(s * (1 - abs(j * 4 / 3.0::DOUBLE - pos))) AS x FROM spread GROUP BY ALL),
frames AS (
  SELECT sensor_id, clip_no, f AS frame, j - f * {_F.hop} AS k, x FROM signal, range({DETECT_CLIP}) AS fs(f)
  WHERE j BETWEEN f * {_F.hop} AND f * {_F.hop} + {_F.window - 1} AND f * {_F.hop} + {_F.window} <= m),
basis AS (
  SELECT k, b, 0.5 - 0.5 * cos(2 * pi() * k / {_F.window}) AS h, 2 * pi() * k * b / {_F.fft} AS angle
  FROM range({_F.window}) AS ks(k), range({_F.bins}) AS bs(b)),
spectrum AS (
  SELECT sensor_id, clip_no, frame, b, sqrt(pow(sum(x * h * cos(angle)), 2) + pow(sum(x * h * sin(angle)), 2)) AS mag
  FROM frames JOIN basis USING (k) GROUP BY ALL),
log_mel AS (
  SELECT sensor_id, clip_no, frame, band, ln(sum(mag * w) + {_F.log_offset}) AS v FROM spectrum JOIN mel USING (b) GROUP BY ALL),
patches AS (
  SELECT sensor_id, clip_no, frame // {_F.patch_frames} AS example, (frame % {_F.patch_frames}) * {_F.bands} + band AS cell, v FROM log_mel
  QUALIFY count(*) OVER (PARTITION BY sensor_id, clip_no, frame // {_F.patch_frames}) = {DETECT_CELLS}),
embedded AS (
  SELECT sensor_id, clip_no, example, o AS i, sum(v * cos((o + 1) * (cell + 1)) / {DETECT_CELLS}) AS x
  FROM patches, range({EMBED_DIM}) AS os(o) GROUP BY ALL),
whitened AS (
  SELECT sensor_id, clip_no, example, o AS i, sum(cos((o + 1) * (i + 1)) * (x - i / 10.0)) AS x
  FROM embedded, range({EMBED_DIM}) AS os(o) GROUP BY ALL),
pooled AS (SELECT sensor_id, clip_no, i, avg(x) AS x FROM whitened WHERE example < {DETECT.max_frames} GROUP BY ALL),
scored AS (
  SELECT sensor_id, clip_no, class_id, display_name AS label, 1 / (1 + exp(-sum(cos((class_id + 1) * (i + 1)) * x))) AS score
  FROM pooled, classes GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, clip_no ORDER BY score DESC, class_id) AS rank FROM scored
  WHERE score > {DETECT.min_score} QUALIFY rank <= {DETECT.max_predictions})
SELECT c.sensor_id, c.seq, CAST(coalesce(rank, 0) AS BIGINT) AS rank, coalesce(label, '') AS label,
       coalesce(round(score, 6), 0) AS score, CAST(max(CASE WHEN label LIKE '%err%' OR label LIKE '%purch%' THEN 1 ELSE 0 END)
         OVER (PARTITION BY c.sensor_id, c.clip_no) AS BIGINT) AS flag
FROM clip_list c LEFT JOIN ranked r ON c.sensor_id = r.sensor_id AND c.clip_no = r.clip_no"""


@query("clip_detection", DETECTED)
def clip_detection(spark: SparkSession, sf: str) -> DataFrame:
    """Clips to prediction lists in one pass: resample, patches, model, projection, scores, ranking, flag."""
    rows = clips(spark, sf, DETECT_CLIP).transform(detect(classifier(spark, sf), DETECT, kernel="linear"))
    return detected(rows)


PARTIAL = "class_id % 2 = 0"


@query(
    "partial_dictionary",
    f"""SELECT sensor_id, seq, CAST(sum(CASE WHEN rank > 0 AND {PARTIAL} THEN 1 ELSE 0 END) AS BIGINT) AS n_known,
       coalesce(string_agg(CASE WHEN rank > 0 AND {PARTIAL} THEN label END, '|' ORDER BY rank), '') AS labels,
       coalesce(string_agg(CASE WHEN rank > 0 AND NOT {PARTIAL} THEN class_id::VARCHAR END, '|' ORDER BY rank), '') AS unknown_ids,
       CAST(max(CASE WHEN {PARTIAL} AND (label LIKE '%err%' OR label LIKE '%purch%') THEN 1 ELSE 0 END) AS BIGINT) AS flag
FROM ({DETECTED}) LEFT JOIN (WITH {CLASSES} SELECT class_id, display_name FROM classes) ON label = display_name GROUP BY sensor_id, seq""",
)
def partial_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Detection with a dictionary that names every other class: the rest of the kept classes come back as ids, no clip is lost."""
    whole = classifier(spark, sf)
    found = clips(spark, sf, DETECT_CLIP).transform(detect(replace(whole, classes=whole.classes.where(PARTIAL)), DETECT, kernel="linear"))
    return found.select(
        "sensor_id", "seq", F.size("predictions").cast("bigint").alias("n_known"), F.array_join("predictions.label", "|").alias("labels"),
        F.array_join(F.col("unknown_classes").cast("array<string>"), "|").alias("unknown_ids"), *big("flag"),
    )
