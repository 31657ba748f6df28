"""Clips from WAV files, and keyed messages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from acoustic_spark.functions.waveform import channel_count, decode_pcm16, encode_pcm16

# Fixed layout of the canonical 44-byte header (1-based byte positions).
WAV_HEADER_BYTES = 44
_CHANNELS_AT, _RATE_AT, _BITS_AT, _DATA_SIZE_AT = 23, 25, 35, 41
_PCM = 1
#: Splits of a folder's scan that one task reads.
SPLITS = 16


def _number(content: Column, at: int, size: int) -> Column:
    """Little-endian unsigned number of `size` bytes."""
    digits = [F.hex(F.substring(content, at + b, 1)) for b in reversed(range(size))]
    return F.conv(F.concat(*digits), 16, 10).cast("bigint")


def _little_endian(value: Column, size: int) -> Column:
    """Hex text of a number, lowest byte first."""
    digits = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
    return F.concat(*[F.substring(digits, 2 * b + 1, 2) for b in reversed(range(size))])


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds; null if none does. A rule that gives null does not hold."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(broken, name).otherwise(reason)
    return reason


def accepted(rows: DataFrame) -> DataFrame:
    """The rows of a checked table that are clips."""
    return rows.filter("reason IS NULL").drop("n_bytes", "reason")


def rejected(rows: DataFrame) -> DataFrame:
    """The others, with the size of their content and the reason; contents are not decoded for them."""
    return rows.filter("reason IS NOT NULL").drop("sample_rate", "n_channels", "n_samples", "samples")


def checked_wav(files: DataFrame) -> DataFrame:
    """(path, content) rows to clips with n_bytes and reason; where a reason is given the clip columns are null.

    Reasons, the first that holds: `header` (no canonical header of 44 bytes), `format` (not PCM), `bits` (not 16),
    `channels` (none), `size` (more data announced than there is), `uneven` (the data end within a frame).
    """
    content = F.coalesce("content", F.lit(b""))
    text = lambda at, size: F.substring(content, at, size)
    size, channels = _number(content, _DATA_SIZE_AT, 4), _number(content, _CHANNELS_AT, 2)
    header = (text(1, 4) == F.lit(b"RIFF")) & (text(9, 4) == F.lit(b"WAVE")) & (text(37, 4) == F.lit(b"data"))
    reason = first_reason(
        ("header", (F.length(content) < WAV_HEADER_BYTES) | ~header),
        ("format", _number(content, 21, 2) != _PCM),
        ("bits", _number(content, _BITS_AT, 2) != 16),
        ("channels", channels == 0),
        ("size", size > F.length(content) - WAV_HEADER_BYTES),
        ("uneven", size % (channels * 2) != 0),
    )
    rows = files.withColumns({"n_bytes": F.length(content).cast("long"), "reason": reason})
    whole = lambda value: F.when(F.col("reason").isNull(), value)
    return rows.select(
        *[c for c in files.columns if c != "content"],
        whole(_number(content, _RATE_AT, 4).cast("int")).alias("sample_rate"),
        whole(channels.cast("int")).alias("n_channels"),
        whole(F.floor(size / 2).cast("int")).alias("n_samples"),
        decode_pcm16(whole(F.substring(content, F.lit(WAV_HEADER_BYTES + 1), size.cast("int")))).alias("samples"),
        "n_bytes",
        "reason",
    )


def parse_wav(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, content) rows to clips, and the files that are none with n_bytes and reason."""
    rows = checked_wav(files)
    return accepted(rows), rejected(rows)


def read_wav(spark: SparkSession, folder: str, glob: str = "*.wav") -> tuple[DataFrame, DataFrame]:
    """Clips of a folder of WAV files, and the rejected files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return parse_wav(fewer_tasks(files.select("path", "content")))


def fewer_tasks(files: DataFrame) -> DataFrame:
    """Files with SPLITS of Spark's splits in each task, but two tasks a core at least.

    Spark counts a file as 4 MB however small it is, so that a task has 32 files at most; starting it and its Python worker
    takes longer than reading them. Rows go through a task in batches, so the memory doesn't grow with its files.
    """
    splits = files.rdd.getNumPartitions()
    return files.coalesce(max(splits // SPLITS, min(splits, 2 * files.sparkSession.sparkContext.defaultParallelism), 1))


def write_files(files: DataFrame, folder: str) -> int:
    """Write each (path, content) row as a file below a folder that all executors share; returns how many.

    A task that runs again writes the same files again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = pafs.FileSystem.from_uri(folder)
        made: set[str] = set()
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                parent = f"{root}/{path}".rsplit("/", 1)[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(f"{root}/{path}") as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(batch)]})

    return files.select("path", "content").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def wav_content(samples: Column, n_channels: Column, sample_rate: Column) -> Column:
    """File content of a clip: canonical header and 16-bit payload."""
    size = F.size(samples) * 2
    header = F.concat(
        F.hex(F.lit("RIFF")), _little_endian(size + 36, 4), F.hex(F.lit("WAVE")), F.hex(F.lit("fmt ")),
        _little_endian(F.lit(16), 4), _little_endian(F.lit(_PCM), 2), _little_endian(n_channels, 2),
        _little_endian(sample_rate, 4), _little_endian(sample_rate * n_channels * 2, 4),
        _little_endian(n_channels * 2, 2), _little_endian(F.lit(16), 2), F.hex(F.lit("data")),
        _little_endian(size, 4),
    )
    return F.concat(F.unhex(header), encode_pcm16(samples))


# --- messages -----------------------------------------------------------------


def to_messages(clips: DataFrame, n_frames: int | None = None, *carried: str) -> DataFrame:
    """Key and payload of each clip, with the carried columns; only clips of `n_frames` frames when given."""
    kept = clips if n_frames is None else clips.filter(F.col("n_samples") == F.col("n_channels") * n_frames)
    return kept.select(
        F.col("sensor_id").cast("string").cast("binary").alias("key"),
        encode_pcm16(F.col("samples")).alias("value"),
        *carried,
    )


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Write messages to a batch sink."""
    messages.write.format(fmt).options(**options).mode("append").save()


def publish_stream(messages: DataFrame, checkpoint: str, fmt: str = "kafka", **options: str) -> DataStreamWriter:
    """Writer that sends a stream of messages to a sink."""
    return messages.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)


def checked_messages(messages: DataFrame, n_frames: int | None = None, sample_rate: int = 22_050) -> DataFrame:
    """Sensor id and samples of each message, with n_bytes and reason; where a reason is given the clip columns are null.

    With `n_frames` the channel count is the payload length over it; otherwise
    the clip is mono. Reasons, the first that holds: `empty` (no payload or one without bytes), `odd` (half a sample
    at the end), `short` (fewer samples than frames), `uneven` (the samples fill no whole number of channels).
    Whatever a message holds, it ends neither a job nor a stream.
    """
    size = F.coalesce(F.length("value"), F.lit(0))
    n_samples = F.floor(size / 2).cast("int")
    rules = [("empty", size == 0), ("odd", size % 2 != 0)]
    if n_frames is not None:
        rules += [("short", n_samples < n_frames), ("uneven", n_samples % n_frames != 0)]
    rest = [c for c in messages.columns if c not in ("key", "value")]
    rows = messages.withColumns({"n_bytes": size.cast("long"), "reason": first_reason(*rules)})
    whole = lambda value: F.when(F.col("reason").isNull(), value)
    return rows.select(
        F.col("key").cast("string").alias("sensor_id"),
        *rest,
        whole(F.lit(sample_rate)).alias("sample_rate"),
        whole(F.lit(1) if n_frames is None else channel_count(n_samples, n_frames)).alias("n_channels"),
        whole(n_samples).alias("n_samples"),
        decode_pcm16(whole(F.col("value"))).alias("samples"),
        "n_bytes",
        "reason",
    )


def from_messages(messages: DataFrame, n_frames: int | None = None, sample_rate: int = 22_050) -> DataFrame:
    """The clips among the messages; `checked_messages` has the others too."""
    return accepted(checked_messages(messages, n_frames, sample_rate))

