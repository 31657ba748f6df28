"""Queries on messages, detections, the log and its views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from acoustic_spark.functions.text import (
    archive_path,
    epoch_seconds,
    format_predictions,
    headline,
    headline_colour,
    log_time,
    predictions_json,
    print_predictions,
    record_name,
    sound_class_title,
    strip_line_end,
    view_time,
)
from acoustic_spark.functions.waveform import has_frames, in_int16_range
from acoustic_spark.operators import toplists
from acoustic_spark.operators.scoring import name_classes, sorted_predictions, top_scores
from acoustic_spark.plans.registry import query
from acoustic_spark.plans.tables import (
    CLASSES,
    CLIP_SAMPLES,
    DETECTIONS,
    RULES,
    SCORES,
    SERIES,
    SMALL,
    classes,
    clip_rows,
    clips,
    detections,
    read,
    scores,
    series,
)
from acoustic_spark.sources import archive
from acoustic_spark.sources import clips as clip_source
from acoustic_spark.sources import detection_log as log
from acoustic_spark.sources.dimensions import metric_log, read_classes, read_clip_meta
from acoustic_spark.workspace import shared_folder


@query(
    "latest_detection",
    f"""WITH {DETECTIONS}
SELECT sensor_id, strftime(ts, '%Y-%m-%d_%H:%M:%S') AS dt, CAST(flag AS BIGINT) AS flag, formatted AS predictions
FROM detections QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY ingest_seq DESC) = 1""",
)
def latest_detection(spark: SparkSession, sf: str) -> DataFrame:
    return detections(spark, sf, latest=True).select(
        "sensor_id",
        log_time(F.col("ts")).alias("dt"),
        F.col("flag").cast("bigint").alias("flag"),
        format_predictions(F.col("predictions")).alias("predictions"),
    )


@query(
    "latest_overall",
    f"""WITH {DETECTIONS}
SELECT sensor_id, ingest_seq, CAST(flag AS BIGINT) AS flag, formatted AS predictions
FROM detections ORDER BY ingest_seq DESC LIMIT 1""",
)
def latest_overall(spark: SparkSession, sf: str) -> DataFrame:
    """The last appended detection of all sensors."""
    return toplists.latest_overall(detections(spark, sf), "ingest_seq").select(
        "sensor_id",
        "ingest_seq",
        F.col("flag").cast("bigint").alias("flag"),
        format_predictions(F.col("predictions")).alias("predictions"),
    )


# --- sources and sinks ----------------------------------------------------------


def wav_folder(spark: SparkSession, sf: str, spoil: bool = False) -> str:
    """Every clip as a WAV file; with `spoil` some are cut, or have a header that says something else. Returns the folder."""
    folder = shared_folder(spark, "wav")
    content = clip_source.wav_content(F.col("samples"), F.col("n_channels"), F.col("sample_rate"))
    if spoil:
        start, rest = F.substring(content, F.lit(1), F.lit(22)), F.substring(content, F.lit(25), F.length(content))
        spoilt = {1: F.substring(content, F.lit(1), F.lit(30)), 2: F.substring(content, F.lit(1), F.length(content) - 1)}
        spoilt |= {3: F.concat(start, F.lit(b"\0\0"), rest), 4: F.concat(start, F.lit(b"\3\0"), rest)}
        for case, bad in spoilt.items():
            content = F.when(F.col("clip_no") % 5 == case, bad).otherwise(content)
    path = F.concat(F.lit("clips/"), F.col("sensor_id"), F.lit("/"), F.col("clip_no"), F.lit(".wav"))
    clip_source.write_files(clips(spark, sf).select(path.alias("path"), content.alias("content")), folder)
    return folder


@query(
    "wav_rejects",
    f"""WITH {SERIES}, {clip_rows()}, files AS (SELECT DISTINCT sensor_id, clip_no, n_samples FROM clip_rows)
SELECT 'clips/' || sensor_id || '/' || clip_no || '.wav' AS path,
       CASE clip_no % 5 WHEN 1 THEN 'header' WHEN 2 THEN 'size' WHEN 3 THEN 'channels' WHEN 4 THEN
         CASE WHEN n_samples % 3 <> 0 THEN 'uneven' ELSE '' END ELSE '' END AS reason,
       CAST(CASE clip_no % 5 WHEN 1 THEN 30 WHEN 2 THEN 43 + 2 * n_samples ELSE 44 + 2 * n_samples END AS BIGINT) AS n_bytes
FROM files""",
)
def wav_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A folder with spoilt files: every file is a clip or has a reason, and none ends the scan."""
    parsed, rejects = clip_source.read_wav(spark, wav_folder(spark, sf, spoil=True))
    sizes = parsed.select("path", F.lit("").alias("reason"), (F.col("n_samples").cast("bigint") * 2 + 44).alias("n_bytes"))
    return sizes.unionByName(rejects.select("path", "reason", "n_bytes")).withColumn("path", F.regexp_extract("path", "clips/.*", 0))


@query(
    "wav_scan",
    f"""WITH {SERIES}, {clip_rows()}
SELECT 'clips/' || sensor_id || '/' || clip_no || '.wav' AS path, CAST({SMALL.sample_rate} AS BIGINT) AS sample_rate,
       CAST(1 AS BIGINT) AS n_channels, CAST(n_samples AS BIGINT) AS n_samples, CAST(pos AS BIGINT) AS pos, s AS sample
FROM clip_rows""",
)
def wav_scan(spark: SparkSession, sf: str) -> DataFrame:
    """All clips written as WAV files, then found and read by a scan of the folder."""
    parsed, _ = clip_source.read_wav(spark, wav_folder(spark, sf))
    parsed = parsed.withColumn("path", F.regexp_extract("path", "clips/.*", 0))
    return parsed.select(
        "path",
        F.col("sample_rate").cast("bigint"),
        F.col("n_channels").cast("bigint"),
        F.col("n_samples").cast("bigint"),
        F.posexplode("samples").alias("pos", "sample"),
    ).withColumns({"pos": F.col("pos").cast("bigint"), "sample": F.col("sample").cast("bigint")})


@query(
    "publish_clips",
    f"""WITH {SERIES}, {clip_rows()}
SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(n_samples * 2 AS BIGINT) AS payload_bytes,
       string_agg(printf('%02X%02X', s % 256, s // 256), '' ORDER BY pos) AS payload
FROM clip_rows GROUP BY sensor_id, clip_no, n_samples""",
)
def publish_clips(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed messages written to a sink and read back."""
    folder = shared_folder(spark, "messages")
    clip_source.publish(clip_source.to_messages(clips(spark, sf)), "parquet", path=folder)
    return spark.read.parquet(folder).select(
        F.col("key").cast("string").alias("sensor_id"),
        F.length("value").cast("bigint").alias("payload_bytes"),
        F.hex("value").alias("payload"),
    )


@query(
    "detection_log_parse",
    f"""WITH {DETECTIONS}
SELECT CAST(d.sensor_id AS VARCHAR) AS sensor_id, strftime(d.ts, '%Y-%m-%d %H:%M:%S') AS ts,
       CAST(d.flag AS BIGINT) AS flag, coalesce(d.path, '') AS path, CAST(coalesce(p.rank, 0) AS BIGINT) AS rank,
       coalesce(p.label, '') AS label, coalesce(p.score, 0) AS score
FROM detections d LEFT JOIN predictions p ON d.sensor_id = p.sensor_id AND d.day = p.day""",
)
def detection_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as text and parsed back."""
    folder = shared_folder(spark, "log-text")
    log.write_log_text(detections(spark, sf), folder)
    parsed, _ = log.read_log(spark, folder)
    return parsed.select(
        "sensor_id",
        view_time(F.col("ts")).alias("ts"),
        F.col("flag").cast("bigint").alias("flag"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.posexplode_outer("predictions").alias("pos", "p"),
    ).select(
        "sensor_id",
        "ts",
        "flag",
        "path",
        F.coalesce(F.col("pos") + 1, F.lit(0)).cast("bigint").alias("rank"),
        F.coalesce("p.label", F.lit("")).alias("label"),
        F.coalesce("p.score", F.lit(0.0)).alias("score"),
    )


@query(
    "detection_log_append",
    f"""WITH {DETECTIONS}
SELECT sensor_id || '|' || strftime(ts, '%Y-%m-%d_%H:%M:%S') || '|' || flag || '|' || printed || '|' || coalesce(path, '') AS line
FROM detections""",
)
def detection_log_append(spark: SparkSession, sf: str) -> DataFrame:
    """Detections appended to the log table, shown in the text form of the log."""
    folder = shared_folder(spark, "log-table")
    log.append_log(detections(spark, sf), folder)
    return log.log_lines(spark.read.parquet(folder)).withColumnRenamed("value", "line")


@query(
    "clip_archive",
    f"""WITH {SERIES}, {clip_rows()}
SELECT CAST(sensor_id AS BIGINT) AS sensor_id, CAST(count(DISTINCT clip_no) AS BIGINT) AS n_clips,
       CAST(count(*) AS BIGINT) AS n_samples, CAST(sum(s) AS BIGINT) AS total
FROM clip_rows GROUP BY ALL""",
)
def clip_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Clips archived by sensor and read back."""
    folder = shared_folder(spark, "archive")
    archive.store(clips(spark, sf), folder)
    sample_sum = F.aggregate("samples", F.lit(0).cast("bigint"), lambda total, s: total + s)
    return (
        archive.read_archive(spark, folder, "ts")
        .groupBy(F.col("sensor_id").cast("bigint").alias("sensor_id"))
        .agg(
            F.count(F.lit(1)).alias("n_clips"),
            F.sum(F.col("n_samples").cast("bigint")).alias("n_samples"),
            F.sum(sample_sum).alias("total"),
        )
    )


@query("class_dictionary", f"WITH {CLASSES} SELECT CAST(class_id AS BIGINT) AS class_id, display_name FROM classes")
def class_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """The dictionary written as CSV with its header and read back."""
    folder = shared_folder(spark, "classes")
    rows = classes(spark, sf).select("class_id", F.concat(F.lit("/m/"), "class_id").alias("mid"), "display_name")
    rows.write.csv(folder, header=True, escape='"')
    return read_classes(spark, folder).withColumn("class_id", F.col("class_id").cast("bigint"))


@query(
    "clip_metadata",
    """SELECT CAST(doc_id AS VARCHAR) AS video_id, CAST(0 AS DOUBLE) AS start_s, n_chars / 10.0::DOUBLE AS end_s,
       unnest([lang, source]) AS label FROM documents""",
)
def clip_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Clip metadata written as CSV with a quoted label list and read back."""
    folder = shared_folder(spark, "clip-meta")
    read(spark, sf, "documents").select(
        F.col("doc_id").alias("video_id"),
        F.lit(0.0).alias("start_s"),
        (F.col("n_chars") / 10).alias("end_s"),
        F.concat_ws(",", "lang", "source").alias("labels"),
    ).write.csv(folder)
    return read_clip_meta(spark, folder).select("video_id", "start_s", "end_s", F.explode("labels").alias("label"))


@query(
    "prediction_json",
    f"WITH {DETECTIONS} SELECT sensor_id, CAST(day AS VARCHAR) AS day, json AS notification FROM detections",
)
def prediction_json(spark: SparkSession, sf: str) -> DataFrame:
    return detections(spark, sf).select(
        "sensor_id", F.col("day").cast("string").alias("day"), predictions_json(F.col("predictions")).alias("notification")
    )


@query("metric_log", "SELECT event_id AS step, value AS loss FROM events WHERE event_id % 10 = 0")
def metrics(spark: SparkSession, sf: str) -> DataFrame:
    steps = read(spark, sf, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss"))
    return metric_log(steps)


# --- projections and filters ---------------------------------------------------------


@query(
    "message_decode",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def message_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Key and decoded value of each message."""
    messages = read(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").cast("binary").alias("key"), F.col("props").alias("value")
    )
    return messages.select(
        "event_id",
        F.col("key").cast("string").alias("sensor_id"),
        F.get_json_object("value", "$.k").cast("bigint").alias("k"),
    )


@query(
    "exact_length_clips",
    f"""WITH {SERIES}, {clip_rows()}
SELECT sensor_id, CAST(clip_no AS BIGINT) AS clip_no, CAST(n_samples AS BIGINT) AS n_samples
FROM clip_rows WHERE n_samples = {CLIP_SAMPLES} AND pos = 0""",
)
def exact_length_clips(spark: SparkSession, sf: str) -> DataFrame:
    whole = clips(spark, sf).filter(has_frames(F.col("n_samples"), F.col("n_channels"), CLIP_SAMPLES))
    return whole.select("sensor_id", "clip_no", F.col("n_samples").cast("bigint").alias("n_samples"))


@query(
    "nonempty_paths",
    f"WITH {DETECTIONS} SELECT sensor_id, CAST(day AS VARCHAR) AS day, path FROM detections WHERE length(path) > 0",
)
def nonempty_paths(spark: SparkSession, sf: str) -> DataFrame:
    return (
        detections(spark, sf)
        .filter(F.length("path") > 0)
        .select("sensor_id", F.col("day").cast("string").alias("day"), "path")
    )


@query(
    "int16_guard",
    """SELECT user_id AS sensor_id, CAST(count(*) FILTER (WHERE abs(round(value * 1000)) <= 32767) AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE abs(round(value * 1000)) > 32767) AS BIGINT) AS rejected FROM events GROUP BY ALL""",
)
def int16_guard(spark: SparkSession, sf: str) -> DataFrame:
    fits = in_int16_range(F.round(F.col("value") * 1000))
    return (
        read(spark, sf, "events")
        .groupBy(F.col("user_id").alias("sensor_id"))
        .agg(F.count_if(fits).alias("accepted"), F.count_if(~fits).alias("rejected"))
    )


@query(
    "log_times",
    """SELECT event_id, strftime(ts, '%Y-%m-%d_%H:%M:%S') AS log_time, strftime(ts, '%Y-%m-%d %H:%M:%S') AS view_time FROM events""",
)
def log_times(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        "event_id", log_time(F.col("ts")).alias("log_time"), view_time(F.col("ts")).alias("view_time")
    )


@query(
    "archive_paths",
    """SELECT event_id, 'clips/' || user_id || '/' || strftime(ts, '%Y-%m-%d_%H:%M:%S') || '.wav' AS path,
       'record_' || CAST(round_even(epoch_us(ts) / 1e6, 0) AS BIGINT) || '.wav' AS record FROM events""",
)
def archive_paths(spark: SparkSession, sf: str) -> DataFrame:
    folder = F.concat(F.lit("clips/"), F.col("user_id"), F.lit("/"))
    return read(spark, sf, "events").select(
        "event_id",
        archive_path(folder, F.col("ts")).alias("path"),
        record_name(epoch_seconds(F.col("ts"))).alias("record"),
    )


@query(
    "formatted_predictions",
    f"WITH {DETECTIONS} SELECT sensor_id, CAST(day AS VARCHAR) AS day, formatted FROM detections",
)
def formatted_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return detections(spark, sf).select(
        "sensor_id", F.col("day").cast("string").alias("day"), format_predictions(F.col("predictions")).alias("formatted")
    )


@query(
    "headlines",
    f"""WITH {DETECTIONS}
SELECT sensor_id, CAST(day AS VARCHAR) AS day,
       CASE WHEN flag = 1 THEN 'GUNSHOT DETECTED near ' ELSE 'No threats near ' END || sensor_id || ' at '
         || strftime(ts, '%Y-%m-%d_%H:%M:%S') AS headline,
       CASE WHEN flag = 1 THEN 'r' ELSE 'b' END AS colour, 'Sound class:' || printed AS title
FROM detections""",
)
def headlines(spark: SparkSession, sf: str) -> DataFrame:
    sensor = F.col("sensor_id").cast("string")
    return detections(spark, sf).select(
        "sensor_id",
        F.col("day").cast("string").alias("day"),
        headline(F.col("flag"), sensor, log_time(F.col("ts"))).alias("headline"),
        headline_colour(F.col("flag")).alias("colour"),
        sound_class_title(print_predictions(F.col("predictions"))).alias("title"),
    )


@query("line_ends", "SELECT event_id, props AS line FROM events")
def line_ends(spark: SparkSession, sf: str) -> DataFrame:
    ended = F.concat(F.col("props"), F.lit("\r\n"))
    return read(spark, sf, "events").select("event_id", strip_line_end(ended).alias("line"))


# --- predictions and alerts ---------------------------------------------------------------


@query(
    "top_classes",
    f"""WITH {CLASSES}, {SCORES}
SELECT sensor_id, CAST(day AS VARCHAR) AS day, CAST(class_id AS BIGINT) AS class_id, score, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, day ORDER BY score DESC, class_id) AS rank
      FROM scores WHERE score > 0.1) WHERE rank <= 20""",
)
def top_classes(spark: SparkSession, sf: str) -> DataFrame:
    return top_scores(scores(spark, sf), ["sensor_id", "day"], RULES).select(
        "sensor_id",
        F.col("day").cast("string").alias("day"),
        F.col("class_id").cast("bigint").alias("class_id"),
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


@query(
    "top_class_per_sensor",
    f"""WITH {CLASSES}, {SCORES}
SELECT sensor_id, CAST(class_id AS BIGINT) AS class_id, CAST(day AS VARCHAR) AS day, score, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY score DESC, seq, class_id) AS rank FROM scores)
WHERE rank <= 3""",
)
def top_class_per_sensor(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("score"), F.asc("seq"), F.asc("class_id")]
    return toplists.top_n_per_key(scores(spark, sf), ["sensor_id"], order, 3).select(
        "sensor_id",
        F.col("class_id").cast("bigint").alias("class_id"),
        F.col("day").cast("string").alias("day"),
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


@query(
    "named_classes",
    f"""WITH {CLASSES}, {SCORES}
SELECT sensor_id, CAST(day AS VARCHAR) AS day, display_name AS label, score FROM scores JOIN classes USING (class_id)""",
)
def named_classes(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = classes(spark, sf)
    named, _ = name_classes(scores(spark, sf, dictionary), dictionary)
    return named.select("sensor_id", F.col("day").cast("string").alias("day"), "label", "score")


@query(
    "alert_flags",
    f"""WITH {DETECTIONS}
SELECT sensor_id, CAST(day AS VARCHAR) AS day, CAST(flag AS BIGINT) AS flag, CAST(n_predictions AS BIGINT) AS n_predictions
FROM detections""",
)
def alert_flags(spark: SparkSession, sf: str) -> DataFrame:
    return detections(spark, sf).select(
        "sensor_id",
        F.col("day").cast("string").alias("day"),
        F.col("flag").cast("bigint").alias("flag"),
        F.size("predictions").cast("bigint").alias("n_predictions"),
    )


@query(
    "sorted_predictions",
    f"""WITH {DETECTIONS}
SELECT sensor_id, CAST(day AS VARCHAR) AS day, score,
       CAST(row_number() OVER (PARTITION BY sensor_id, day ORDER BY score DESC, label) AS BIGINT) AS rank, label
FROM predictions""",
)
def sort_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Unordered lists put in order of falling score."""
    unordered = detections(spark, sf).withColumn("predictions", F.array_sort("predictions"))
    return unordered.select(
        "sensor_id",
        F.col("day").cast("string").alias("day"),
        F.posexplode(sorted_predictions(F.col("predictions"))).alias("pos", "p"),
    ).select("sensor_id", "day", "p.score", (F.col("pos") + 1).cast("bigint").alias("rank"), "p.label")


# --- views ------------------------------------------------------------------------------


@query(
    "recent_events",
    """SELECT user_id AS sensor_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS text,
       CAST(least(10, n) - age + 1 AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age,
             count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE age <= 10""",
)
def recent_events(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").withColumnRenamed("user_id", "sensor_id")
    return toplists.recent_events(events, ["sensor_id"], "ts", "event_id").select(
        "sensor_id",
        "event_id",
        view_time(F.col("ts")).alias("at"),
        F.col("event_type").alias("text"),
        F.col("rank").cast("bigint").alias("rank"),
    )


@query(
    "recent_events_overall",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS text
FROM events ORDER BY ts DESC, event_id DESC LIMIT 10""",
)
def recent_events_overall(spark: SparkSession, sf: str) -> DataFrame:
    recent = toplists.recent_events_overall(read(spark, sf, "events"), "ts", "event_id")
    return recent.select("event_id", view_time(F.col("ts")).alias("at"), F.col("event_type").alias("text"))


@query(
    "detection_counts",
    f"""WITH {DETECTIONS}
SELECT sensor_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS total_count,
       CAST(sum(flag) AS BIGINT) AS gun_count, round(avg(flag), 6) AS alert_rate
FROM detections GROUP BY sensor_id, CAST(ts AS DATE)""",
)
def detection_counts(spark: SparkSession, sf: str) -> DataFrame:
    return toplists.detection_counts(detections(spark, sf)).select(
        "sensor_id",
        F.col("day").cast("string").alias("day"),
        "total_count",
        "gun_count",
        F.round("alert_rate", 6).alias("alert_rate"),
    )


@query(
    "first_record",
    "SELECT event_id, user_id AS sensor_id, value FROM events ORDER BY event_id LIMIT 1",
)
def first_record(spark: SparkSession, sf: str) -> DataFrame:
    return toplists.first_record(read(spark, sf, "events"), "event_id").select(
        "event_id", F.col("user_id").alias("sensor_id"), "value"
    )


@query("sensor_positions", f"WITH {SERIES} SELECT sensor_id, event_id, CAST(i AS BIGINT) AS i, CAST(n AS BIGINT) AS n FROM series")
def sensor_positions(spark: SparkSession, sf: str) -> DataFrame:
    return series(spark, sf).select("sensor_id", "event_id", F.col("i").cast("bigint").alias("i"), F.col("n").cast("bigint").alias("n"))
