"""A folder of many small files is read by few tasks."""

import struct

from pyspark.sql import functions as F

from acoustic_spark.sources import clips as C


def test_many_small_files_take_few_tasks(spark, tmp_path):
    for i in range(700):
        data = struct.pack("<2h", i, -i)
        head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 40, b"WAVE", b"fmt ", 16, 1, 1, 8_000, 16_000, 2, 16, b"data", len(data))
        folder = tmp_path / f"d{i % 20}"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.wav").write_bytes(head + data)
    clips, rejects = C.read_wav(spark, str(tmp_path))
    found = clips.select(F.regexp_extract("path", r"(\d+)\.wav", 1).cast("int").alias("i"), "samples").collect()
    assert sorted((r.i, r.samples) for r in found) == [(i, [i, -i]) for i in range(700)] and rejects.count() == 0
    assert clips.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
