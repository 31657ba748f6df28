"""How the test tables are read as sensors, samples, clips and scores.

`events` stands for the sensor data: the user is the sensor, `event_id` the ingest
sequence, `value` the sample, and the event type the sound class. The SQL texts
give the same tables for the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from acoustic_spark.config import DetectConfig, FeatureConfig
from acoustic_spark.functions.text import log_time
from acoustic_spark.operators.positions import with_position
from acoustic_spark.operators.scoring import name_classes, prediction_lists
from acoustic_spark.operators.toplists import rows_of_latest
from acoustic_spark.workspace import local_table

# A small setting that gives every sensor of the test tables several frames and patches.
SMALL = FeatureConfig(
    sample_rate=8_000, window=16, hop=8, bands=4, lower_hz=125.0, upper_hz=3_800.0, patch_frames=3, value_type="double"
)
CLIP_SAMPLES = 20
RULES = DetectConfig(alert_patterns=("err", "purch"))
MAX_CLASSES = 10_000


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def series(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of each sensor with their position and the sensor's sample count."""
    events = read(spark, sf, "events").select(
        F.col("user_id").alias("sensor_id"), "event_id", "ts", F.col("value").alias("x")
    )
    return with_position(events, ["sensor_id"], "event_id")


SERIES = """series AS (
  SELECT user_id AS sensor_id, event_id, value AS x,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM events)"""


def clips(spark: SparkSession, sf: str, length: int = CLIP_SAMPLES) -> DataFrame:
    """Int16 clips of `length` samples cut from each sensor's series; the last one may be shorter."""
    sample = F.round(F.col("x") * 10).cast("smallint")
    return (
        series(spark, sf)
        .groupBy("sensor_id", F.floor(F.col("i") / length).alias("clip_no"))
        .agg(
            F.array_sort(F.collect_list(F.struct("i", sample.alias("s")))).alias("_rows"),
            F.min("event_id").alias("seq"),
            F.min("ts").alias("ts"),
        )
        .select(
            "sensor_id",
            "clip_no",
            "seq",
            "ts",
            F.lit(SMALL.sample_rate).alias("sample_rate"),
            F.lit(1).alias("n_channels"),
            F.size("_rows").alias("n_samples"),
            F.col("_rows.s").alias("samples"),
        )
    )


def clip_rows(length: int = CLIP_SAMPLES) -> str:
    """SQL of the clip samples: one row per clip and sample."""
    return f"""clip_rows AS (
  SELECT sensor_id, i // {length} AS clip_no, i % {length} AS pos, CAST(round(x * 10) AS BIGINT) AS s,
         event_id, least({length}, n - (i // {length}) * {length}) AS n_samples
  FROM series)"""


def classes(spark: SparkSession, sf: str) -> DataFrame:
    """Class dictionary: event types numbered in alphabetical order, as a local relation."""
    names = read(spark, sf, "events").select("event_type").distinct().limit(MAX_CLASSES + 1).collect()
    if len(names) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    schema = T.StructType([T.StructField("class_id", T.IntegerType()), T.StructField("display_name", T.StringType())])
    return local_table(spark, list(enumerate(sorted(r[0] for r in names))), schema)


CLASSES = """classes AS (
  SELECT event_type AS display_name, row_number() OVER (ORDER BY event_type) - 1 AS class_id
  FROM (SELECT DISTINCT event_type FROM events))"""


def score(value):
    return F.round(F.lit(1.0) - F.exp(-value / 50), 6)


def scores(spark: SparkSession, sf: str, dictionary: DataFrame | None = None) -> DataFrame:
    """Class scores of each clip, a clip being one sensor on one day."""
    events = read(spark, sf, "events")
    best = events.groupBy(
        F.col("user_id").alias("sensor_id"), F.to_date("ts").alias("day"), F.col("event_type").alias("display_name")
    ).agg(F.max("value").alias("value"), F.max("event_id").alias("seq"), F.max("ts").alias("ts"))
    known = classes(spark, sf) if dictionary is None else dictionary
    return best.join(F.broadcast(known), "display_name").select(
        "sensor_id", "day", "class_id", score(F.col("value")).alias("score"), "seq", "ts"
    )


SCORES = """scores AS (
  SELECT user_id AS sensor_id, CAST(ts AS DATE) AS day, class_id,
         round(1.0 - exp(-max(value) / 50), 6) AS score, max(event_id) AS seq, max(ts) AS ts
  FROM events JOIN classes ON event_type = display_name
  GROUP BY ALL)"""


def detections(spark: SparkSession, sf: str, latest: bool = False) -> DataFrame:
    """One detection per clip: prediction list, flag, time, path and append order; with `latest` of each sensor's newest clip alone."""
    dictionary = classes(spark, sf)
    found = scores(spark, sf, dictionary)
    named, _ = name_classes(rows_of_latest(found, ["sensor_id"], ["day"], "seq") if latest else found, dictionary)
    lists = prediction_lists(
        named, ["sensor_id", "day"], RULES, F.max("seq").alias("ingest_seq"), F.max("ts").alias("ts")
    )
    path = F.concat(F.lit("archive/"), F.col("sensor_id"), F.lit("/"), log_time(F.col("ts")), F.lit(".wav"))
    return lists.withColumn("path", F.when(F.size("predictions") > 0, path))


# Predictions ranked per clip, and the detection row with flattened lists.
DETECTIONS = f"""{CLASSES}, {SCORES}, ranked AS (
  SELECT s.*, display_name AS label, row_number() OVER (PARTITION BY sensor_id, day ORDER BY score DESC, s.class_id) AS rank
  FROM scores s JOIN classes c ON s.class_id = c.class_id WHERE score > 0.1),
predictions AS (SELECT * FROM ranked WHERE rank <= 20),
listed AS (
  SELECT sensor_id, day, count(*) AS n_predictions,
         max(CASE WHEN label LIKE '%err%' OR label LIKE '%purch%' THEN 1 ELSE 0 END) AS flag,
         '[' || string_agg('(''' || label || ''', ' || CAST(score AS VARCHAR) || ')', ', ' ORDER BY rank) || ']' AS printed,
         '[' || string_agg('["' || label || '", ' || CAST(score AS VARCHAR) || ']', ', ' ORDER BY rank) || ']' AS json,
         string_agg(label || ': ' || printf('%.2f', score), ', ' ORDER BY rank) AS formatted
  FROM predictions GROUP BY ALL),
detections AS (
  SELECT c.sensor_id, c.day, c.seq AS ingest_seq, c.ts, coalesce(flag, 0) AS flag,
         coalesce(n_predictions, 0) AS n_predictions, coalesce(printed, '[]') AS printed,
         coalesce(json, '[]') AS json, coalesce(formatted, '') AS formatted,
         CASE WHEN n_predictions > 0 THEN
           'archive/' || c.sensor_id || '/' || strftime(c.ts, '%Y-%m-%d_%H:%M:%S') || '.wav' END AS path
  FROM (SELECT sensor_id, day, max(seq) AS seq, max(ts) AS ts FROM scores GROUP BY ALL) c
  LEFT JOIN listed l ON c.sensor_id = l.sensor_id AND c.day = l.day)"""
