"""Live state as tables kept between micro-batches: the capture buffer and the recent events.

The processors in `state` keep each sensor in one task. Here a micro-batch is
handled like any other table, so a hot sensor is spread over many tasks and the
order inside a batch does not matter. The buffer needs chunks of one size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from acoustic_spark.operators.positions import SLICE_ROWS, with_position
from acoustic_spark.operators.toplists import recent_events
from acoustic_spark.streaming.detection import write_batch


def fill_buffers(
    chunks: DataFrame, min_chunks: int, slice_rows: int = SLICE_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Complete buffers of `min_chunks` chunks by sequence number, and the chunks left over."""
    numbered = with_position(chunks, ["sensor_id"], "seq", slice_rows=slice_rows)
    complete = F.floor(F.col("n") / min_chunks) * min_chunks
    buffers = (
        numbered.filter(F.col("i") < complete)
        .groupBy("sensor_id", F.floor(F.col("i") / min_chunks).alias("_buffer"))
        .agg(F.array_sort(F.collect_list(F.struct("seq", "samples"))).alias("_chunks"))
        .select(
            "sensor_id",
            F.element_at("_chunks", 1)["seq"].alias("first_seq"),
            F.element_at("_chunks", -1)["seq"].alias("last_seq"),
            F.flatten("_chunks.samples").alias("samples"),
        )
    )
    return buffers, numbered.filter(F.col("i") >= complete).select(*chunks.columns)


def with_previous(rows: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The rows of a batch together with the state the batch before it left."""
    if batch_id == 0:
        return rows
    before = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/batch_id={batch_id - 1}")
    return rows.unionByName(before)


def write_state(rows: DataFrame, path: str, batch_id: int) -> None:
    """State after a batch in a folder of its own, which exists even when the state is empty."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def capture_action(
    folder: str, min_chunks: int, slice_rows: int = SLICE_ROWS
) -> Callable[[DataFrame, int], None]:
    """Action for `foreachBatch` on (sensor_id, seq, samples): full buffers to `buffers`, the others to `rest`.

    Each batch reads the rest of the one before and writes under its own id, so a
    replay gives the same tables.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        chunks = with_previous(batch.select("sensor_id", "seq", "samples"), f"{folder}/rest", batch_id)
        buffers, left = fill_buffers(chunks, min_chunks, slice_rows)
        write_batch(buffers, f"{folder}/buffers", batch_id)
        write_state(left, f"{folder}/rest", batch_id)

    return run


def recent_action(folder: str, size: int = 10) -> Callable[[DataFrame, int], None]:
    """Action for `foreachBatch` on (sensor_id, ts, seq, text): the newest events of every sensor after each batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        events = with_previous(batch.select("sensor_id", "ts", "seq", "text"), folder, batch_id)
        write_state(recent_events(events, ["sensor_id"], "ts", "seq", size).drop("rank"), folder, batch_id)

    return run
