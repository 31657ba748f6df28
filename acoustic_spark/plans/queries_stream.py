"""Streaming queries: each runs over the whole table until the input is used up, then shows its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from acoustic_spark.functions.text import clip_path, format_predictions, log_time, view_time
from acoustic_spark.operators.capture import capture_rows
from acoustic_spark.operators.toplists import latest_per_key, top_n_per_key
from acoustic_spark.plans.detect import detect
from acoustic_spark.plans.queries_features import big
from acoustic_spark.plans.queries_scoring import DETECT, DETECT_CLIP, DETECTED, classifier, detected
from acoustic_spark.plans.registry import query
from acoustic_spark.plans.tables import DETECTIONS, SERIES, SMALL, clip_rows, clips, detections, read, series
from acoustic_spark.sources.archive import bucket_of, close_batches, read_archive
from acoustic_spark.sources.clips import checked_messages, from_messages, publish, to_messages
from acoustic_spark.sources.detection_log import detection_rows
from acoustic_spark.sources.stream import subscribe
from acoustic_spark.streaming import detection, state
from acoustic_spark.streaming.tables import capture_action, recent_action
from acoustic_spark.workspace import shared_folder


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    # As a pattern the path may be one file or a folder of files.
    return subscribe(spark, "parquet", read(spark, sf, "events").schema, path=f"{sf}/events.parque[t]")


def collect_stream(stream: DataFrame, folder: str, mode: str = "Append") -> DataFrame:
    """Run a stream to the end of its input and give everything it wrote, with the batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        detection.write_batch(batch, f"{folder}/out", batch_id)

    writer = detection.micro_batches(stream, write, f"{folder}/checkpoint", available_now=True).outputMode(mode)
    detection.run_for(writer)
    return stream.sparkSession.read.schema(T.StructType([*stream.schema, T.StructField("batch_id", T.LongType())])).parquet(f"{folder}/out")


@query("stream_subscribe", "SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, props AS value FROM events")
def stream_subscribe(spark: SparkSession, sf: str) -> DataFrame:
    stream = event_stream(spark, sf).select(
        "event_id", F.col("user_id").cast("string").alias("sensor_id"), F.col("props").alias("value")
    )
    return collect_stream(stream, shared_folder(spark, "subscribe")).drop("batch_id")


@query("stream_lifecycle", "SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS active FROM events")
def stream_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Start, await and stop; the rows the query reports having read."""
    folder = shared_folder(spark, "lifecycle")
    writer = detection.micro_batches(
        event_stream(spark, sf),
        lambda batch, batch_id: detection.write_batch(batch.agg(F.count(F.lit(1)).alias("n")), f"{folder}/out", batch_id),
        f"{folder}/checkpoint",
        available_now=True,
    )
    run = detection.run_for(writer)
    counts = spark.read.parquet(f"{folder}/out")
    return counts.agg(F.sum("n").alias("input_rows")).withColumn("active", F.lit(int(run.isActive)).cast("bigint"))


MESSAGE = "key BINARY, value BINARY, timestamp TIMESTAMP_NTZ, offset BIGINT"


def clip_topic(spark: SparkSession, sf: str, files: int = 4) -> str:
    """Clips published as keyed messages to a folder of a few files; returns the folder."""
    folder = shared_folder(spark, "topic")
    sent = clips(spark, sf, DETECT_CLIP).withColumnsRenamed({"seq": "offset", "ts": "timestamp"})
    messages = to_messages(sent, None, "timestamp", "offset")
    publish(messages.repartition(files, "offset"), "parquet", path=folder)
    return folder


def clip_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded clips of the topic, one file per micro-batch."""
    messages = subscribe(spark, "parquet", MESSAGE, path=clip_topic(spark, sf), maxFilesPerTrigger="1")
    return from_messages(messages, sample_rate=SMALL.sample_rate)


def detection_run(spark: SparkSession, sf: str, archive: bool = False, first_only: bool = False) -> str:
    """Classify and log the whole topic, archive it when asked; returns the output folder."""
    folder = shared_folder(spark, "stream-detection")
    classify = detect(classifier(spark, sf), DETECT, kernel="linear")
    action = detection.detection_batch(
        lambda rows: detection_rows(classify(rows), "archive"),
        f"{folder}/log",
        f"{folder}/archive" if archive else None,
        first_only=first_only,
        counts_path=f"{folder}/counts",
        clip_path=clip_path("archive", F.col("sensor_id"), F.col("timestamp"), F.col("offset")),
    )
    checkpoint = f"{folder}/checkpoint"
    detection.run_for(detection.micro_batches(clip_stream(spark, sf), action, checkpoint, available_now=True))
    return folder


# Every event is a message whose payload is the start of its text, of 0 to 10 bytes: whole clips of
# INTAKE_FRAMES frames, and every kind of reject.
INTAKE_FRAMES = 2
INTAKE = f"""intake AS (
  SELECT *, CASE WHEN n_bytes = 0 THEN 'empty' WHEN n_bytes % 2 <> 0 THEN 'odd' WHEN n_bytes // 2 < {INTAKE_FRAMES} THEN 'short'
    WHEN n_bytes // 2 % {INTAKE_FRAMES} <> 0 THEN 'uneven' END AS reason FROM (
    SELECT *, strlen(payload) AS n_bytes FROM (
      SELECT event_id, user_id, CASE WHEN event_id % 11 > 0 THEN substr(props, 1, event_id % 11) ELSE '' END AS payload FROM events)))"""


def intake_messages(events: DataFrame) -> DataFrame:
    start = F.substring(F.col("props").cast("binary"), F.lit(1), (F.col("event_id") % 11).cast("int"))
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), start.alias("value"), F.col("ts").alias("timestamp"), F.col("event_id").alias("offset")
    )


@query(
    "message_intake",
    f"""WITH {INTAKE}
SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, CAST(n_bytes AS BIGINT) AS n_bytes, coalesce(reason, '') AS reason,
       CASE WHEN reason IS NULL THEN CAST(n_bytes // 2 // {INTAKE_FRAMES} AS BIGINT) ELSE 0 END AS n_channels,
       CASE WHEN reason IS NULL THEN CAST(list_sum(list_transform(range(1, n_bytes + 1),
         lambda b: CASE WHEN b % 2 = 1 THEN 1 ELSE 256 END * ascii(substr(payload, b, 1)))) AS BIGINT) ELSE 0 END AS total
FROM intake""",
)
def message_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Every message as a clip, with its channels and the sum of its samples, or as a reject with its reason."""
    rows = checked_messages(intake_messages(read(spark, sf, "events")), INTAKE_FRAMES)
    total = F.aggregate(F.coalesce("samples", F.array().cast("array<smallint>")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return rows.select(
        F.col("offset").alias("event_id"), "sensor_id", "n_bytes", F.coalesce("reason", F.lit("")).alias("reason"),
        F.coalesce(F.col("n_channels").cast("bigint"), F.lit(0).cast("bigint")).alias("n_channels"), total.alias("total"),
    )


@query(
    "stream_intake",
    f"""WITH {INTAKE}
SELECT 'received' AS outcome, count(*) AS n FROM intake UNION ALL SELECT 'logged', count(*) FILTER (reason IS NULL) FROM intake
UNION ALL SELECT 'counted rejects', count(reason) FROM intake UNION ALL SELECT reason, count(*) FROM intake WHERE reason IS NOT NULL GROUP BY reason""",
)
def stream_intake(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of all messages: what was received, logged, and rejected for each reason, as its counts, log and rejects say."""
    folder = shared_folder(spark, "intake")
    stream = checked_messages(intake_messages(event_stream(spark, sf)), INTAKE_FRAMES)
    action = detection.detection_batch(
        lambda rows: rows.drop("samples"), f"{folder}/log", counts_path=f"{folder}/counts", rejects_path=f"{folder}/rejects"
    )
    detection.run_for(detection.micro_batches(stream, action, f"{folder}/checkpoint", available_now=True))
    counts = spark.read.parquet(f"{folder}/counts")
    sums = [counts.agg(F.sum(c).alias("n")).select(F.lit(name).alias("outcome"), "n") for c, name in (("received", "received"), ("rejected", "counted rejects"))]
    logged = spark.read.parquet(f"{folder}/log").agg(F.count(F.lit(1)).alias("n")).select(F.lit("logged").alias("outcome"), "n")
    reasons = spark.read.parquet(f"{folder}/rejects").groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return sums[0].unionByName(sums[1]).unionByName(logged).unionByName(reasons)


@query("stream_detection", DETECTED)
def stream_detection(spark: SparkSession, sf: str) -> DataFrame:
    """The detection log written by the stream; equal to the batch result."""
    log = spark.read.parquet(f"{detection_run(spark, sf)}/log")
    return detected(log.withColumn("sensor_id", F.col("sensor_id").cast("bigint")).withColumnRenamed("ingest_seq", "seq"))


@query(
    "stream_log",
    f"""SELECT CAST(sensor_id AS VARCHAR) AS sensor_id, seq AS ingest_seq, strftime(ts, '%Y-%m-%d_%H:%M:%S') AS at,
       max(flag) AS flag, CAST(count(*) FILTER (WHERE rank > 0) AS BIGINT) AS n_predictions,
       'archive/' || sensor_id || '/' || strftime(ts, '%Y-%m-%d_%H:%M:%S') || '_' || seq || '.wav' AS path
FROM ({DETECTED}) JOIN events ON event_id = seq GROUP BY sensor_id, seq, ts""",
)
def stream_log(spark: SparkSession, sf: str) -> DataFrame:
    """One log row per clip with its time, flag and archive path."""
    log = spark.read.parquet(f"{detection_run(spark, sf)}/log")
    return log.select(
        "sensor_id",
        "ingest_seq",
        log_time(F.col("ts")).alias("at"),
        *big("flag"),
        F.size("predictions").cast("bigint").alias("n_predictions"),
        "path",
    )


def per_sensor(clips: DataFrame) -> DataFrame:
    return clips.groupBy(F.col("sensor_id").cast("bigint").alias("sensor_id")).agg(
        F.count(F.lit(1)).alias("archived"), F.sum(F.col("n_samples").cast("bigint")).alias("n_samples")
    )


@query(
    "stream_archive",
    f"""WITH {SERIES}, {clip_rows(DETECT_CLIP)}, logged AS (
  SELECT sensor_id, count(DISTINCT clip_no) AS n, count(*) AS n_samples FROM clip_rows GROUP BY ALL)
SELECT sensor_id, CAST(n AS BIGINT) AS archived, CAST(n AS BIGINT) AS logged, CAST(n_samples AS BIGINT) AS n_samples FROM logged""",
)
def stream_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Clips archived by sensor and clips logged, per sensor."""
    folder = detection_run(spark, sf, archive=True)
    sensor = F.col("sensor_id").cast("bigint").alias("sensor_id")
    archived = per_sensor(read_archive(spark, f"{folder}/archive"))
    logged = spark.read.parquet(f"{folder}/log").groupBy(sensor).agg(F.count(F.lit(1)).alias("logged"))
    return archived.join(logged, "sensor_id", "full").select("sensor_id", "archived", "logged", "n_samples")


@query(
    "archived_samples",
    f"""WITH {SERIES}, {clip_rows(DETECT_CLIP)}, named AS (
  SELECT sensor_id, clip_no, min(event_id) AS seq FROM clip_rows GROUP BY ALL)
SELECT 'archive/' || sensor_id || '/' || strftime(e.ts, '%Y-%m-%d_%H:%M:%S') || '_' || seq || '.wav' AS path,
       CAST(pos AS BIGINT) AS pos, s AS sample
FROM clip_rows JOIN named USING (sensor_id, clip_no) JOIN events e ON e.event_id = seq""",
)
def archived_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of every logged clip, found in the archive by the logged path."""
    folder = detection_run(spark, sf, archive=True)
    logged = spark.read.parquet(f"{folder}/log").select(bucket_of(F.col("sensor_id")).alias("bucket"), "path")
    found = logged.join(read_archive(spark, f"{folder}/archive").select("bucket", "path", "samples"), ["bucket", "path"])
    return found.select("path", F.posexplode("samples").alias("pos", "sample")).select("path", *big("pos", "sample"))


@query(
    "closed_archive",
    f"""WITH {SERIES}, {clip_rows(DETECT_CLIP)}, named AS (
  SELECT sensor_id, clip_no, min(event_id) AS seq, count(*) AS n_samples, sum(s) AS total FROM clip_rows GROUP BY ALL)
SELECT CAST(e.ts AS DATE)::VARCHAR AS day, CAST(count(*) AS BIGINT) AS n_clips, CAST(count(DISTINCT sensor_id) AS BIGINT) AS n_sensors,
       CAST(sum(n_samples) AS BIGINT) AS n_samples, CAST(sum(total) AS BIGINT) AS total
FROM named JOIN events e ON e.event_id = seq GROUP BY ALL""",
)
def closed_archive(spark: SparkSession, sf: str) -> DataFrame:
    """The archive of a stream by day, with its first batches closed, and again, and its last still live."""
    path = f"{detection_run(spark, sf, archive=True)}/archive"
    for upto in (0, 2, 2):
        close_batches(spark, path, upto)
    sample_sum = F.aggregate("samples", F.lit(0).cast("bigint"), lambda total, s: total + s)
    return read_archive(spark, path).groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_clips"), F.countDistinct("sensor_id").alias("n_sensors"),
        F.sum(F.col("n_samples").cast("bigint")).alias("n_samples"), F.sum(sample_sum).alias("total"),
    )


@query(
    "stream_first_record",
    f"""WITH {SERIES} SELECT CAST(count(DISTINCT (sensor_id, i // {DETECT_CLIP})) AS BIGINT) AS received,
       CAST(4 AS BIGINT) AS kept, CAST(count(DISTINCT (sensor_id, i // {DETECT_CLIP})) - 4 AS BIGINT) AS dropped,
       CAST(4 AS BIGINT) AS logged FROM series""",
)
def stream_first_record(spark: SparkSession, sf: str) -> DataFrame:
    """Only the first clip of each micro-batch is classified; the others are counted."""
    folder = detection_run(spark, sf, first_only=True)
    logged = spark.read.parquet(f"{folder}/log").agg(F.count(F.lit(1)).alias("logged"))
    counts = spark.read.parquet(f"{folder}/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in ("received", "kept", "dropped")]).withColumn(
        "logged", F.lit(logged.first()[0]).cast("bigint")
    )


@query(
    "micro_batches",
    f"""WITH {SERIES} SELECT CAST(count(DISTINCT (sensor_id, i // {DETECT_CLIP})) AS BIGINT) AS clips,
       CAST(4 AS BIGINT) AS batches FROM series""",
)
def micro_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Every micro-batch counted: one per file of the topic."""
    counted = collect_stream(clip_stream(spark, sf).select("sensor_id", "offset"), shared_folder(spark, "batches"))
    return counted.agg(F.count(F.lit(1)).alias("clips"), F.countDistinct("batch_id").alias("batches"))


# --- live state ----------------------------------------------------------------------------

MIN_CHUNKS, MAX_CHUNKS = 5, 7

BUFFERS = f"""WITH {SERIES}
SELECT sensor_id, CAST(i // {MIN_CHUNKS} AS BIGINT) AS buffer, CAST(min(event_id) AS BIGINT) AS first_seq,
       CAST(max(event_id) AS BIGINT) AS last_seq, CAST(count(*) AS BIGINT) AS n_samples, round(sum(x), 6) AS total
FROM series GROUP BY sensor_id, i // {MIN_CHUNKS} HAVING count(*) = {MIN_CHUNKS}"""


@query("capture_buffers", BUFFERS)
def capture_buffers(spark: SparkSession, sf: str) -> DataFrame:
    """Buffers of an always-ready consumer, from the stored chunks; one event is one chunk of one sample."""
    rows = capture_rows(series(spark, sf), ["sensor_id"], 1, MIN_CHUNKS, MAX_CHUNKS)
    return rows.groupBy("sensor_id", "buffer").agg(
        F.min("event_id").alias("first_seq"),
        F.max("event_id").alias("last_seq"),
        F.count(F.lit(1)).alias("n_samples"),
        F.round(F.sum("x"), 6).alias("total"),
    )


def chunk_stream(spark: SparkSession, sf: str) -> DataFrame:
    return event_stream(spark, sf).select(
        F.col("user_id").alias("sensor_id"), F.col("event_id").alias("seq"), F.array("value").alias("samples")
    )


def buffer_rows(buffers: DataFrame, *columns: str) -> DataFrame:
    total = F.aggregate("samples", F.lit(0.0), lambda t, x: t + x)
    return buffers.select(
        "sensor_id",
        *columns,
        "first_seq",
        "last_seq",
        F.size("samples").cast("bigint").alias("n_samples"),
        F.round(total, 6).alias("total"),
    )


@query("capture_stream", BUFFERS)
def capture_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same buffers from live state."""
    state.use_rocksdb(spark)
    filled = state.capture_stream(chunk_stream(spark, sf), MIN_CHUNKS, MAX_CHUNKS, key_type="BIGINT")
    return buffer_rows(collect_stream(filled, shared_folder(spark, "capture")).where("rejected IS NULL"), "buffer")


@query(
    "capture_detection",
    f"""WITH {SERIES}, {clip_rows(DETECT_CLIP)} SELECT * FROM ({DETECTED}) AS d
WHERE seq IN (SELECT min(event_id) FROM clip_rows GROUP BY sensor_id, clip_no HAVING count(*) = {DETECT_CLIP})""",
)
def capture_detection(spark: SparkSession, sf: str) -> DataFrame:
    """Live buffers of int16 chunks classified as they fill; one event is one chunk of one sample."""
    state.use_rocksdb(spark)
    sample = F.round(F.col("value") * 10).cast("smallint")
    chunks = event_stream(spark, sf).select(F.col("user_id").alias("sensor_id"), F.col("event_id").alias("seq"), F.array(sample).alias("samples"))
    buffers = state.capture_stream(chunks, DETECT_CLIP, DETECT_CLIP, key_type="BIGINT")
    found = state.captured_clips(buffers, SMALL.sample_rate).transform(detect(classifier(spark, sf), DETECT, kernel="linear"))
    return detected(collect_stream(found, shared_folder(spark, "capture-detection")))


@query("capture_table", f"SELECT * EXCLUDE (buffer) FROM ({BUFFERS})")
def capture_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same buffers from a table kept between micro-batches, with hot sensors spread."""
    folder = shared_folder(spark, "capture-table")
    action = capture_action(folder, MIN_CHUNKS)
    checkpoint = f"{folder}/checkpoint"
    detection.run_for(detection.micro_batches(chunk_stream(spark, sf), action, checkpoint, available_now=True))
    return buffer_rows(spark.read.parquet(f"{folder}/buffers"))


RECENT = """SELECT user_id AS sensor_id, event_id AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS text,
       CAST(least(10, n) - age + 1 AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS age,
             count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE age <= 10"""


def text_events(spark: SparkSession, sf: str) -> DataFrame:
    return event_stream(spark, sf).select(
        F.col("user_id").alias("sensor_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("text"),
    )


@query("recent_stream", RECENT)
def recent_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The newest list of each sensor after the whole stream; equal to the batch view."""
    state.use_rocksdb(spark)
    out = collect_stream(state.recent_stream(text_events(spark, sf), key_type="BIGINT"), shared_folder(spark, "recent"), "Update")
    newest = latest_per_key(out, ["sensor_id", "rank"], "batch_id")
    return newest.select("sensor_id", "seq", view_time(F.col("ts")).alias("at"), "text", *big("rank"))


@query("recent_table", RECENT.replace("CAST(least(10, n) - age + 1 AS BIGINT) AS rank", "CAST(age AS BIGINT) AS age"))
def recent_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists from a table kept between micro-batches, numbered from the newest."""
    folder = shared_folder(spark, "recent-table")
    writer = detection.micro_batches(
        text_events(spark, sf), recent_action(f"{folder}/recent"), f"{folder}/checkpoint", available_now=True
    )
    detection.run_for(writer)
    states = spark.read.parquet(f"{folder}/recent")
    newest = states.filter(F.col("batch_id") == states.agg(F.max("batch_id")).first()[0])
    ranked = top_n_per_key(newest, ["sensor_id"], [F.desc("ts"), F.desc("seq")], 10, "age")
    return ranked.select("sensor_id", "seq", view_time(F.col("ts")).alias("at"), "text", *big("age"))


@query(
    "notification_stream",
    f"WITH {DETECTIONS} SELECT sensor_id, ingest_seq, json AS notification, formatted FROM detections",
)
def notification_stream(spark: SparkSession, sf: str) -> DataFrame:
    """JSON payloads of a detection stream handed to a sink."""
    folder = shared_folder(spark, "notifications")
    detections(spark, sf).select("sensor_id", "ingest_seq", "predictions").write.parquet(f"{folder}/log")
    stream = subscribe(spark, "parquet", spark.read.parquet(f"{folder}/log").schema, path=f"{folder}/log")
    with_text = stream.withColumn("formatted", format_predictions(F.col("predictions")))
    action = detection.notify(
        "predictions", lambda batch, batch_id: detection.write_batch(batch, f"{folder}/out", batch_id)
    )
    detection.run_for(detection.micro_batches(with_text, action, f"{folder}/checkpoint", available_now=True))
    return spark.read.parquet(f"{folder}/out").select("sensor_id", "ingest_seq", "notification", "formatted")
