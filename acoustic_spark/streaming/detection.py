"""Streaming detection: classify each micro-batch, archive it, log it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from acoustic_spark.functions.text import predictions_json
from acoustic_spark.operators.toplists import first_record
from acoustic_spark.sources.archive import store_batch
from acoustic_spark.sources.clips import accepted, rejected

TRIGGER = "2 seconds"


def write_batch(rows: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """Write one micro-batch under its id; a replay of the batch replaces what it wrote before."""
    (
        rows.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id", *partitions)
        .parquet(path)
    )


def detection_batch(
    classify: Callable[[DataFrame], DataFrame],
    log_path: str,
    archive_path: str | None = None,
    first_only: bool = False,
    order: Sequence[str] = ("offset",),
    counts_path: str | None = None,
    clip_path: Column | None = None,
    rejects_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Action for `foreachBatch`: archive the clips, then log their detections.

    The archive comes first, and keeps `clip_path` as its column path: with the path of
    the log there, a logged clip is always found by it. A batch that has a column reason, as
    `checked_messages` gives it, is split by it: only rows without one are clips, the others go to `rejects_path`. `first_only` keeps
    the first clip of each batch; `counts_path` then holds what was left out. Rows are counted in a pass of their own that decodes
    nothing (metrics observed within the other jobs count twice where a plan samples its input for a sort).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        checked = batch if "reason" in batch.columns else batch.withColumns({"reason": F.lit(None).cast("string"), "n_bytes": F.lit(None).cast("long")})
        rows = first_record(accepted(checked), *order) if first_only else accepted(checked)
        if archive_path is not None:
            kept = rows if clip_path is None else rows.withColumn("path", clip_path)
            store_batch(kept, archive_path, batch_id)
        write_batch(classify(rows), log_path, batch_id)
        if rejects_path is not None:
            write_batch(rejected(checked), rejects_path, batch_id)
        if counts_path is not None:
            counted = checked.agg(F.count(F.lit(1)).alias("received"), F.count("reason").alias("rejected"))
            clips = F.col("received") - F.col("rejected")
            used = F.least(clips, F.lit(1).cast("long")) if first_only else clips
            write_batch(counted.select("received", used.alias("kept"), (clips - used).alias("dropped"), "rejected"), counts_path, batch_id)

    return run


def notify(predictions: str, send: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Action for `foreachBatch`: hand the JSON payloads of a batch to a sink."""

    def run(batch: DataFrame, batch_id: int) -> None:
        send(batch.withColumn("notification", predictions_json(F.col(predictions))).drop(predictions), batch_id)

    return run


def micro_batches(
    stream: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = False
) -> DataStreamWriter:
    """Writer that runs `action` on every micro-batch, by default every two seconds."""
    writer = stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)


def run_for(writer: DataStreamWriter, seconds: float | None = None) -> StreamingQuery:
    """Start a query and wait for it to end; stop it after `seconds` when given."""
    query = writer.start()
    try:
        query.awaitTermination(seconds) if seconds is not None else query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    return query


def first_delivery(stream: DataFrame, delay: str = "1 minute", keys: Sequence[str] = ("sensor_id", "ts")) -> DataFrame:
    """Drop repeats of a clip that arrive within the delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))
