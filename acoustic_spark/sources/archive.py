"""The clip archive: live micro-batches, and closed parts by day and sensor bucket.

    <path>/live/batch_id=K/            a micro-batch, in as many files as its bytes fill
    <path>/closed/upto=N/day=D/bucket=B/    clips up to batch N by day and bucket, sorted by sensor and path

Batches are closed together, so that the number of files goes with the bytes, the days and a fixed number of buckets,
never with the sensors or the batches. A part counts once it is written as a whole. Readers see each clip once at any
time: closed parts, and live batches later than the last of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Sensors are dealt to so many folders a day, whatever their number.
BUCKETS = 8
#: The part of clips that came in no batch.
UNBATCHED = -1


def bucket_of(sensor: Column) -> Column:
    return F.pmod(F.xxhash64(sensor.cast("string")), F.lit(BUCKETS)).cast("int")


def _keyed(clips: DataFrame, time: str) -> DataFrame:
    """Clips with their day (null where they have no column `time`) and bucket."""
    day = F.to_date(F.col(time)) if time in clips.columns else F.lit(None).cast("date")
    return clips.withColumns({"day": day, "bucket": bucket_of(F.col("sensor_id"))})


def _sorted(clips: DataFrame, *first: str) -> DataFrame:
    return clips.sortWithinPartitions(*first, "sensor_id", *(["path"] if "path" in clips.columns else []))


def _write_part(clips: DataFrame, path: str, upto: int, time: str, mode: str) -> None:
    """`rebalance` cuts a hot bucket over several files and brings small ones to one writer."""
    placed = _sorted(_keyed(clips, time).hint("rebalance", "day", "bucket"), "day", "bucket")
    placed.write.mode(mode).partitionBy("day", "bucket").parquet(f"{path}/closed/upto={upto}")


def store(clips: DataFrame, path: str, time: str = "ts", mode: str = "append") -> None:
    """Write clips of a batch job as a closed part."""
    _write_part(clips, path, UNBATCHED, time, mode)


def store_batch(clips: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch under its id; a replay replaces what it wrote before."""
    _sorted(clips.hint("rebalance")).write.mode("overwrite").parquet(f"{path}/live/batch_id={batch_id}")


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders <name>=<number> below path that were written as a whole."""
    system, place = _folder(spark, path)
    if not system.exists(place):
        return []
    found = [s.getPath() for s in system.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(f"{name}=")]
    done = [p for p in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def _live(spark: SparkSession, path: str, after: int, upto: int | None = None) -> DataFrame | None:
    ids = [n for n in _numbers(spark, f"{path}/live", "batch_id") if n > after and (upto is None or n <= upto)]
    if not ids:
        return None
    return spark.read.parquet(*[f"{path}/live/batch_id={n}" for n in ids])


def close_batches(spark: SparkSession, path: str, upto: int, time: str = "timestamp") -> None:
    """Put the live batches up to `upto` into one closed part and delete them.

    Only batches that their stream has committed may be closed. Safe to run again: after a part is written its batches
    count no more, whether deleted or not, and a part that was not finished is written anew.
    """
    last = max(_numbers(spark, f"{path}/closed", "upto"), default=UNBATCHED)
    clips = _live(spark, path, last, upto)
    if clips is not None:
        _write_part(clips, path, upto, time, "overwrite")
        last = upto
    for n in _numbers(spark, f"{path}/live", "batch_id"):
        if n <= last:
            system, place = _folder(spark, f"{path}/live/batch_id={n}")
            system.delete(place, True)


def read_archive(spark: SparkSession, path: str, time: str = "timestamp") -> DataFrame:
    """All clips with their day and bucket."""
    parts = _numbers(spark, f"{path}/closed", "upto")
    live = _live(spark, path, max(parts, default=UNBATCHED))
    tables = []
    if parts:
        # The folder above the parts would be listed with unfinished ones.
        for n in parts:
            part = f"{path}/closed/upto={n}"
            tables.append(spark.read.option("basePath", part).parquet(part).withColumn("day", F.col("day").cast("date")))
    if live is not None:
        tables.append(_keyed(live, time))
    if not tables:
        raise ValueError(f"no clips in {path}")
    table = tables[0]
    for more in tables[1:]:
        table = table.unionByName(more)
    return table


def find_clips(archive: DataFrame, sensor_id: str, path: str | None = None) -> DataFrame:
    """Clips of a sensor, or that of a path: one bucket is read, of it the row groups that may hold the sensor and path."""
    found = archive.where((F.col("bucket") == bucket_of(F.lit(sensor_id))) & (F.col("sensor_id") == sensor_id))
    return found if path is None else found.where(F.col("path") == path)
