"""Files, messages, the log and the side tables."""

import struct

import pytest
from pyspark.sql import functions as F

from acoustic_spark.functions.text import parse_predictions, print_predictions
from acoustic_spark.functions.waveform import decode_pcm16, encode_pcm16
from acoustic_spark.schemas import DETECTIONS
from acoustic_spark.sources import archive as A
from acoustic_spark.sources import clips as C
from acoustic_spark.sources import detection_log as L
from acoustic_spark.sources import dimensions as D


def wav_bytes(samples, channels=1, rate=22_050, bits=16, code=1):
    data = struct.pack(f"<{len(samples)}h", *samples)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, code, channels, rate,
                       rate * channels * bits // 8, channels * bits // 8, bits, b"data", len(data))
    return head + data


def test_wav_folder(spark, tmp_path):
    signals = {"a": ([1, -2, 32_767, -32_768], 1), "b": ([5, 6, 7, 8], 2), "empty": ([], 1)}
    for name, (samples, channels) in signals.items():
        (tmp_path / f"{name}.wav").write_bytes(wav_bytes(samples, channels))
    (tmp_path / "float.wav").write_bytes(wav_bytes([1, 2], bits=32, code=3))
    (tmp_path / "cut.wav").write_bytes(wav_bytes([1, 2])[:30])
    (tmp_path / "notes.txt").write_text("no clip")
    clips, rejects = C.read_wav(spark, str(tmp_path))
    found = {r.path.rsplit("/", 1)[1][:-4]: r for r in clips.collect()}
    assert {n: (r.samples, r.n_channels) for n, r in found.items()} == signals
    assert found["b"].sample_rate == 22_050 and found["b"].n_samples == 4
    assert sorted(r.path.rsplit("/", 1)[1] for r in rejects.collect()) == ["cut.wav", "float.wav"]


def test_every_wav_file_is_a_clip_or_has_a_reason(spark, tmp_path):
    good = wav_bytes([1, 2, 3, 4], 2)
    files = {
        "good": good, "header": b"", "header2": good[:43], "header3": b"RIFX" + good[4:], "format": wav_bytes([1], code=3), "bits": wav_bytes([1], bits=8),
        "channels": wav_bytes([1], channels=0), "size": good[:-2], "uneven": wav_bytes([1, 2, 3], 2), "uneven2": good[:40] + struct.pack("<I", 7) + good[44:],
    }
    df = spark.createDataFrame([(n, bytearray(c)) for n, c in files.items()] + [("header4", None)], "path STRING, content BINARY")
    clips, rejects = C.parse_wav(df)
    assert [(r.path, r.samples, r.n_channels) for r in clips.collect()] == [("good", [1, 2, 3, 4], 2)]
    found = {r.path: r.reason for r in rejects.collect()}
    assert found == {n: n.rstrip("234") for n in [*files, "header4"] if n != "good"}


def test_messages_of_any_content(spark):
    values = {"ok": b"\1\0\2\0", "two": b"\1\0\2\0\3\0\4\0", "empty": b"", "none": None, "odd": b"\1\0\2", "short": b"\1\0", "uneven": b"\1\0\2\0\3\0"}
    df = spark.createDataFrame([(bytearray(k.encode()), v if v is None else bytearray(v)) for k, v in values.items()], "key BINARY, value BINARY")
    rows = {r.sensor_id: r for r in C.checked_messages(df, 2).collect()}
    assert {k: r.reason for k, r in rows.items()} == {"ok": None, "two": None, "empty": "empty", "none": "empty", "odd": "odd", "short": "short", "uneven": "uneven"}
    assert (rows["ok"].samples, rows["ok"].n_channels, rows["two"].n_channels) == ([1, 2], 1, 2)
    assert all(r.samples is None and r.n_channels is None for r in rows.values() if r.reason)
    assert {r.sensor_id for r in C.rejected(C.checked_messages(df)).collect()} == {"empty", "none", "odd"}  # mono of any length
    assert C.from_messages(df, 2).count() == 2


def test_wav_content(spark):
    df = spark.createDataFrame([([1, -2, 3, 300],)], "samples ARRAY<SMALLINT>")
    content = df.select(C.wav_content(F.col("samples"), F.lit(2), F.lit(16_000))).first()[0]
    assert bytes(content) == wav_bytes([1, -2, 3, 300], 2, 16_000)


def test_pcm_round_trip(spark):
    rows = [(1, [1, -1, 256]), (2, []), (3, None), (4, [-32_768, 32_767])]
    df = spark.createDataFrame(rows, "id INT, samples ARRAY<SMALLINT>").coalesce(1)
    coded = df.withColumn("value", encode_pcm16(F.col("samples")))
    assert [r.value and bytes(r.value) for r in coded.collect()] == [
        struct.pack("<3h", 1, -1, 256), b"", None, struct.pack("<2h", -32_768, 32_767)
    ]
    back = coded.select("id", decode_pcm16(F.col("value")).alias("samples"))
    assert [tuple(r) for r in back.collect()] == rows
    with pytest.raises(Exception, match="odd number"):
        spark.range(1).select(decode_pcm16(F.unhex(F.lit("010203")))).collect()


def test_messages(spark, tmp_path):
    rows = [("s1", 4, 2, [1, 2, 3, 4]), ("s2", 2, 1, [9, 9]), ("s3", 3, 1, [1, 2, 3]), ("s4", 0, 1, [])]
    clips = spark.createDataFrame(rows, "sensor_id STRING, n_samples INT, n_channels INT, samples ARRAY<SMALLINT>")
    assert {r.key.decode() for r in C.to_messages(clips, 2).collect()} == {"s1", "s2"}
    C.publish(C.to_messages(clips), "parquet", path=str(tmp_path / "topic"))
    back = C.from_messages(spark.read.parquet(str(tmp_path / "topic")), n_frames=2)
    assert {(r.sensor_id, r.n_channels, tuple(r.samples)) for r in back.filter("sensor_id != 's3'").collect()} == {
        ("s1", 2, (1, 2, 3, 4)), ("s2", 1, (9, 9)),
    }
    assert back.filter("sensor_id = 's4'").count() == 0


def test_archive_by_day_and_bucket(spark, tmp_path):
    """As many files as days and buckets, whatever the number of sensors; a lookup reads one bucket and says so in the plan."""
    path = str(tmp_path / "archive")
    rows = [(f"s{s}", f"2020-01-0{1 + c % 2} 00:00:00", f"/c/s{s}/{c}.wav", [c]) for s in range(200) for c in range(4)]
    clips = spark.createDataFrame(rows, "sensor_id STRING, ts STRING, path STRING, samples ARRAY<SMALLINT>").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    A.store(clips.repartition(7), path)
    files = list((tmp_path / "archive").rglob("*.parquet"))
    assert len(files) <= 2 * A.BUCKETS
    one = A.find_clips(A.read_archive(spark, path, "ts"), "s7", "/c/s7/2.wav")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(path,/c/s7/2.wav)" in plan
    assert [(r.samples, str(r.day)) for r in one.collect()] == [([2], "2020-01-01")]


def test_closing_batches_is_safe_to_repeat(spark, tmp_path):
    path = str(tmp_path / "archive")
    read = lambda: sorted((r.sensor_id, r.samples[0]) for r in A.read_archive(spark, path).collect())
    batch = lambda n: spark.createDataFrame([(f"s{i}", f"p{n}", [n]) for i in range(3)], "sensor_id STRING, path STRING, samples ARRAY<SMALLINT>")
    every = lambda n: sorted((f"s{i}", b) for b in range(n) for i in range(3))
    for n in (0, 1, 1, 2):
        A.store_batch(batch(n), path, n)
    assert read() == every(3)
    A.close_batches(spark, path, 1)
    A.close_batches(spark, path, 1)
    assert read() == every(3) and [p.name for p in (tmp_path / "archive/live").iterdir()] == ["batch_id=2"]
    A.store_batch(batch(1), path, 1)  # left over from a run that ended before it was deleted
    (tmp_path / "archive/closed/upto=2/day=2020-01-01/bucket=0").mkdir(parents=True)  # a part that was never finished
    A.store_batch(batch(3), path, 3)
    assert read() == every(4)
    A.close_batches(spark, path, 3)
    assert read() == every(4) and not list((tmp_path / "archive/live").iterdir())
    with pytest.raises(ValueError, match="no clips"):
        A.read_archive(spark, str(tmp_path / "none"))


LOG = [
    "s1|2020-05-01_10:00:00|1|[('Speech', 0.5), ('Gunshot, gunfire', 0.4375)]|/clips/a.wav",
    "s1,2020-05-01_10:00:10,0,\"[('Music', 0.99), ('Inside, large room', 1e-05)]\",/clips/b.wav",
    "",
    "*** started again ***",
    "s1|2020-05-01_10:00:20|0|[]|",
    "s2|2020-05-01_10:00:30|0|[('Wind (microphone)', 0.16)]|/clips/c.wav",
    "s2|2020-05-01_10:00:40|0|\"[(\"\"Children's voices\"\", 0.2)]\"|/clips/d.wav",
    "s2|not a time|0|[]|",
    "s2|2020-05-01_10:00:50|0|[('Speech', many)]|/clips/e.wav",
    "s2|2020-05-01_10:01:00|0|[]|/clips/f.wav|one more",
]


def test_log_dialects(spark, tmp_path):
    (tmp_path / "log.csv").write_bytes("\r\n".join(LOG).encode())
    good, rejects = L.read_log(spark, str(tmp_path / "log.csv"))
    rows = {str(r.ts)[-8:]: r for r in good.collect()}
    lists = {at: [(p.label, p.score) for p in r.predictions] for at, r in rows.items()}
    assert lists == {
        "10:00:00": [("Speech", 0.5), ("Gunshot, gunfire", 0.4375)],
        "10:00:10": [("Music", 0.99), ("Inside, large room", 1e-05)],
        "10:00:20": [],
        "10:00:30": [("Wind (microphone)", 0.16)],
        "10:00:40": [("Children's voices", 0.2)],
    }
    assert rows["10:00:20"].path is None and rows["10:00:10"].path == "/clips/b.wav"
    assert [rows[a].flag for a in sorted(rows)] == [1, 0, 0, 0, 0]
    assert sorted(r[0] for r in rejects.collect()) == sorted(["", LOG[3], LOG[7], LOG[8], LOG[9]])


def test_log_text_round_trip(spark, tmp_path):
    labels = ["Speech", "Gunshot, gunfire", "Wind (noise)", "Children's", 'A "quoted" one', "both ' and \"", "back\\slash", "a|b"]
    rows = [("s1", f"2020-01-01 00:00:0{i}", i % 2, [(label, 0.1 + i / 10), ("Music", 0.125)], None if i % 2 else f"/p{i}") for i, label in enumerate(labels)]
    schema = "sensor_id STRING, ts STRING, flag INT, predictions ARRAY<STRUCT<label STRING, score DOUBLE>>, path STRING"
    table = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    L.write_log_text(table, str(tmp_path / "text"))
    back, rejects = L.read_log(spark, str(tmp_path / "text"))
    assert rejects.count() == 0
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_prediction_text_is_a_python_list(spark):
    labels = ["Speech", "Children's", 'A "quoted" one', "both ' and \"", "back\\slash"]
    values = [[(label, 0.5)] for label in labels] + [[]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, p ARRAY<STRUCT<label STRING, score DOUBLE>>")
    got = {r.i: r.t for r in df.select("i", print_predictions(F.col("p")).alias("t")).collect()}
    assert got == {i: repr(v) for i, v in enumerate(values)}
    texts = spark.createDataFrame([(i, repr(v)) for i, v in enumerate(values)], "i INT, t STRING")
    back = {r.i: [tuple(p) for p in r.p] for r in texts.select("i", parse_predictions(F.col("t")).alias("p")).collect()}
    assert back == dict(enumerate(values))


def test_detection_rows(spark):
    rows = [("s1", "2020-01-02 03:04:05.678", 9, 1, [("Gunshot", 0.5)])]
    schema = "sensor_id STRING, timestamp STRING, offset BIGINT, flag INT, predictions ARRAY<STRUCT<label STRING, score DOUBLE>>"
    table = spark.createDataFrame(rows, schema).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    found = L.detection_rows(table, "/clips/")
    assert [f.dataType for f in found.schema] == [f.dataType for f in DETECTIONS]
    assert found.first().path == "/clips/s1/2020-01-02_03:04:05_9.wav" and found.first().ingest_seq == 9


def test_side_tables(spark, tmp_path):
    (tmp_path / "classes.csv").write_text('index,mid,display_name\n0,/m/a,"Gunshot, gunfire"\n1,/m/b,Speech\n2,/m/c,Children\'s\n')
    names = {r.class_id: r.display_name for r in D.read_classes(spark, str(tmp_path / "classes.csv")).collect()}
    assert names == {0: "Gunshot, gunfire", 1: "Speech", 2: "Children's"}
    (tmp_path / "meta.csv").write_text('# id, start, end, labels\nabc, 30.000, 40.000, "/m/a,/m/b"\n-x_1, 0.000, 10.000, "/m/c"\n')
    meta = [tuple(r) for r in D.read_clip_meta(spark, str(tmp_path / "meta.csv")).orderBy("start_s").collect()]
    assert meta == [("-x_1", 0.0, 10.0, ["/m/c"]), ("abc", 30.0, 40.0, ["/m/a", "/m/b"])]
    steps = spark.range(35).select(F.lit(0).alias("epoch"), F.col("id").alias("step"), F.lit(1.0).alias("loss"))
    D.append_metrics(steps, str(tmp_path / "metrics"))
    assert sorted(r.step for r in spark.read.parquet(str(tmp_path / "metrics")).collect()) == [0, 10, 20, 30]
