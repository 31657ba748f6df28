"""Streams against their batch meaning, and replays."""

import pytest
from pyspark.sql import functions as F

from acoustic_spark.sources.archive import read_archive
from acoustic_spark.sources.clips import from_messages, publish_stream, to_messages
from acoustic_spark.sources.stream import subscribe
from acoustic_spark.streaming import detection, state
from acoustic_spark.streaming.tables import capture_action, recent_action


@pytest.fixture(autouse=True)
def rocksdb(spark):
    state.use_rocksdb(spark)


def write_files(spark, folder, batches, schema):
    """One file per micro-batch, in order."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)


def run_stream(spark, tmp_path, stream, mode="Append"):
    """All output rows with their batch id."""
    out = []
    writer = detection.micro_batches(
        stream, lambda b, i: out.extend((i, *r) for r in b.collect()), str(tmp_path / "cp"), available_now=True
    )
    detection.run_for(writer.outputMode(mode))
    return out


CHUNKS = "sensor_id STRING, seq BIGINT, samples ARRAY<DOUBLE>"


def chunk(sensor, seq, size=2):
    return (sensor, seq, [float(seq)] * size)


def test_capture_always_ready(spark, tmp_path):
    batches = [[chunk("a", i) for i in range(7)] + [chunk("b", i) for i in range(3)], [chunk("a", i) for i in range(7, 13)]]
    write_files(spark, str(tmp_path / "in"), batches, CHUNKS)
    stream = subscribe(spark, "parquet", CHUNKS, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    got = sorted(run_stream(spark, tmp_path, state.capture_stream(stream, 10, 14)))
    assert [(r[1], r[2], r[3], r[4]) for r in got] == [("a", 0, 0, 4), ("a", 1, 5, 9)]
    assert got[1][5] == [float(s) for s in range(5, 10) for _ in range(2)]


def test_capture_ready_once_per_batch(spark, tmp_path):
    """The buffer overflows while the consumer is busy: the oldest samples go, inside a chunk too."""
    batches = [[chunk("a", i) for i in range(12)], [chunk("a", 12)], [chunk("a", 13)]]
    write_files(spark, str(tmp_path / "in"), batches, CHUNKS)
    stream = subscribe(spark, "parquet", CHUNKS, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    got = run_stream(spark, tmp_path, state.capture_stream(stream, 10, 13, ready="batch"))
    assert [(r[0], r[2], r[3], r[4]) for r in got] == [(1, 0, 5, 11)]
    assert got[0][5] == [5.0] + [float(s) for s in range(6, 12) for _ in range(2)]


def test_capture_rejects_bad_settings():
    for bad in ((8, 7, "always"), (1, 2, "sometimes")):
        with pytest.raises(ValueError):
            state.CaptureBuffer(*bad)


def test_capture_orders_a_batch_and_rejects_late_chunks(spark, tmp_path):
    """Chunks of a batch in any order; late, repeated and broken ones come back with a reason."""
    batches = [[("a", i, [float(i)] * 2) for i in (6, 0, 3, 1, 2, 5, 4)], [("a", 3, [9.0]), ("a", 7, [7.0, 7.0]), ("a", 8, None), ("a", None, [1.0]), ("a", 9, [None])]]
    write_files(spark, str(tmp_path / "in"), batches, CHUNKS)
    stream = subscribe(spark, "parquet", CHUNKS, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    got = [r[2:] for r in run_stream(spark, tmp_path, state.capture_stream(stream, 8, 10))]
    filled = [r for r in got if r[-1] is None]
    assert [(r[0], r[1], r[2], list(r[3])) for r in filled] == [(0, 0, 3, [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0]), (1, 4, 7, [4.0, 4.0, 5.0, 5.0, 6.0, 6.0, 7.0, 7.0])]
    assert sorted((r[-1], r[1]) for r in got if r[-1] is not None) == [("late", 3), ("no samples", 8), ("no samples", 9), ("no sequence number", None)]


@pytest.mark.parametrize("mixed", [True, False])
def test_capture_of_several_files(spark, tmp_path, mixed):
    """Six files, with rows mixed over them or with disjoint ranges, give the buffers of one."""
    chunks = spark.range(600).select((F.col("id") % 4).cast("string").alias("sensor_id"), F.col("id").alias("seq"), F.array(F.col("id").cast("smallint")).alias("samples"))
    spread = chunks.repartition(6, F.xxhash64("seq")) if mixed else chunks.repartitionByRange(6, "seq")
    spread.write.parquet(str(tmp_path / "in"))
    stream = subscribe(spark, "parquet", chunks.schema, path=str(tmp_path / "in"))
    got = run_stream(spark, tmp_path, state.captured_clips(state.capture_stream(stream, 5, 7)))
    assert sorted((r[1], r[2], r[5]) for r in got) == sorted((str(k), n, [k + 4 * (5 * n + j) for j in range(5)]) for k in range(4) for n in range(30))


def test_capture_table(spark, tmp_path):
    """Buffers over several batches, out of order inside one, with a replay in between."""
    batches = [[chunk("a", i) for i in (6, 0, 3, 1, 2, 5, 4)] + [chunk("b", 0)], [chunk("a", i) for i in (8, 7)], [chunk("b", i) for i in (1, 2, 3)]]
    action = capture_action(str(tmp_path / "out"), 3, slice_rows=2)
    for batch_id, rows in ((0, 0), (1, 1), (1, 1), (2, 2)):
        action(spark.createDataFrame(batches[rows], CHUNKS), batch_id)
    got = sorted((r.sensor_id, r.first_seq, r.last_seq, tuple(r.samples)) for r in spark.read.parquet(str(tmp_path / "out/buffers")).collect())
    want = [("a", s, s + 2) for s in (0, 3, 6)] + [("b", 0, 2)]
    assert got == [(n, a, z, tuple(float(s) for s in range(a, z + 1) for _ in range(2))) for n, a, z in want]


def test_recent_ring(spark, tmp_path):
    schema = "sensor_id STRING, ts TIMESTAMP, seq BIGINT, text STRING"
    rows = spark.range(25).select(
        F.lit("a").alias("sensor_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), F.concat(F.lit("e"), "id").alias("text")
    )
    for low, high in ((12, 25), (0, 12)):
        rows.filter(f"id >= {low} AND id < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = subscribe(spark, "parquet", schema, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    got = run_stream(spark, tmp_path, state.recent_stream(stream), "Update")
    last = max(r[0] for r in got)
    assert [(r[2], r[4]) for r in sorted(got, key=lambda r: r[2]) if r[0] == last] == [(k, 14 + k) for k in range(1, 11)]


def test_recent_table(spark, tmp_path):
    action = recent_action(str(tmp_path / "recent"), 3)
    for batch_id, seqs in ((0, (4, 1, 9)), (1, ()), (1, ()), (2, (2, 7))):
        rows = [("a", float(s), s, f"e{s}") for s in seqs]
        action(spark.createDataFrame(rows, "sensor_id STRING, ts DOUBLE, seq BIGINT, text STRING"), batch_id)
    last = spark.read.parquet(str(tmp_path / "recent/batch_id=2"))
    assert sorted(r.seq for r in last.collect()) == [4, 7, 9]


MESSAGES = "sensor_id STRING, offset BIGINT, samples ARRAY<SMALLINT>"


def classify(clips):
    return clips.withColumn("flag", (F.array_max("samples") > 5).cast("int")).drop("samples")


def test_replayed_batch_is_written_once(spark, tmp_path):
    batch = spark.createDataFrame([("s1", 4, [9]), ("s2", 2, [1]), ("s1", 7, [3])], MESSAGES)
    action = detection.detection_batch(classify, str(tmp_path / "log"), str(tmp_path / "archive"), counts_path=str(tmp_path / "n"))
    for batch_id in (0, 1, 1):
        action(batch, batch_id)
    log = spark.read.parquet(str(tmp_path / "log"))
    assert sorted((r.batch_id, r.offset, r.flag) for r in log.collect()) == [
        (b, o, f) for b in (0, 1) for o, f in ((2, 0), (4, 1), (7, 0))
    ]
    assert read_archive(spark, str(tmp_path / "archive")).count() == 6
    assert sorted((r.batch_id, r.received, r.dropped) for r in spark.read.parquet(str(tmp_path / "n")).collect()) == [(0, 3, 0), (1, 3, 0)]


def test_first_only(spark, tmp_path):
    batch = spark.createDataFrame([("s1", 4, [9]), ("s2", 2, [1])], MESSAGES)
    action = detection.detection_batch(classify, str(tmp_path / "log"), first_only=True, counts_path=str(tmp_path / "n"))
    action(batch, 0)
    assert [r.offset for r in spark.read.parquet(str(tmp_path / "log")).collect()] == [2]
    assert tuple(spark.read.parquet(str(tmp_path / "n")).select("received", "kept", "dropped").first()) == (2, 1, 1)


def test_notifications_and_time_limit(spark, tmp_path):
    schema = "sensor_id STRING, predictions ARRAY<STRUCT<label STRING, score DOUBLE>>"
    write_files(spark, str(tmp_path / "in"), [[("s1", [("Speech", 0.5)]), ("s2", [])]], schema)
    sent = []
    action = detection.notify("predictions", lambda b, i: sent.extend((r.sensor_id, r.notification) for r in b.collect()))
    stream = subscribe(spark, "parquet", schema, path=str(tmp_path / "in"))
    query = detection.run_for(detection.micro_batches(stream, action, str(tmp_path / "cp")), seconds=8)
    assert not query.isActive
    assert sorted(sent) == [("s1", '[["Speech", 0.5]]'), ("s2", "[]")]


def test_published_stream(spark, tmp_path):
    """Clips published from one stream and read back by another."""
    write_files(spark, str(tmp_path / "in"), [[("s1", 1, [1, 2])], [("s2", 2, [-3])]], MESSAGES)
    stream = subscribe(spark, "parquet", MESSAGES, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    messages = to_messages(stream.withColumn("n_samples", F.size("samples")), None, "offset")
    writer = publish_stream(messages, str(tmp_path / "cp"), "parquet", path=str(tmp_path / "topic"))
    detection.run_for(writer.trigger(availableNow=True))
    back = from_messages(spark.read.parquet(str(tmp_path / "topic"))).select("sensor_id", "offset", "samples")
    assert sorted(map(tuple, back.collect())) == [("s1", 1, [1, 2]), ("s2", 2, [-3])]


def test_repeated_delivery(spark, tmp_path):
    schema = "sensor_id STRING, ts TIMESTAMP, seq BIGINT"
    rows = spark.range(6).select(F.lit("a").alias("sensor_id"), F.timestamp_seconds(F.floor(F.col("id") / 2) + 1_000).alias("ts"), F.col("id").alias("seq"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = subscribe(spark, "parquet", schema, path=str(tmp_path / "in"))
    assert len(run_stream(spark, tmp_path, detection.first_delivery(stream))) == 3
