"""Live state per sensor: the capture buffer and the list of recent events.

Both need the RocksDB state store, see `use_rocksdb`.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from acoustic_spark.config import CAPTURE_MAX_SECONDS, CAPTURE_MIN_SECONDS, CAPTURE_RATE

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Stands for a missing sequence number between the plan and the processor.
NO_SEQ = -(1 << 63)
#: How samples lie in the state, by their type in the table.
SAMPLE_TYPES = {"smallint": "<i2", "float": "<f4", "double": "<f8"}
#: Output rows that are handed to Spark together.
ROWS_PER_FRAME = 64


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set(_PROVIDER, _ROCKSDB)


class CaptureBuffer(StatefulProcessor):
    """Keep the newest samples of a sensor and hand the whole buffer over when it is long enough.

    The chunks that a micro-batch brings for a sensor are taken by sequence number, as nothing
    keeps an order in a shuffle. A chunk that cannot be placed is given back with the reason in
    `rejected`: its number is not above one already taken, or it has no number or no whole samples.
    `ready` says when the consumer asks: after every chunk, or once at the start of
    each micro-batch. A sensor never holds more than `max_samples` plus the chunks of one
    micro-batch, which the source's limits (files or offsets a trigger) bound.
    """

    def __init__(self, min_samples: int, max_samples: int, ready: str = "always", sample_type: str = "<i2") -> None:
        if min_samples > max_samples:
            raise ValueError("the minimum is greater than the maximum")
        if ready not in ("always", "batch"):
            raise ValueError(f"unknown ready mode {ready!r}")
        self._min, self._max, self._ready, self._type = min_samples, max_samples, ready, sample_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._progress = handle.getValueState("progress", "last_seq BIGINT, emitted BIGINT")
        self._chunks = handle.getListState("chunks", "seq BIGINT, samples BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, emitted = self._progress.get() if self._progress.exists() else (None, 0)
        stored = self._chunks.get() if self._chunks.exists() else ()
        buffer = deque((s, np.frombuffer(bytes(x), self._type)) for s, x in stored)
        held = sum(len(x) for _, x in buffer)

        def hand_over() -> tuple:
            row = (emitted, buffer[0][0], buffer[-1][0], np.concatenate([x for _, x in buffer]), None)
            buffer.clear()
            return row

        if self._ready == "batch" and held >= self._min:
            yield self._frame(key[0], [hand_over()])
            emitted, held = emitted + 1, 0
        arrived = [
            (int(seq), None if samples is None else np.asarray(samples, self._type))
            for batch in rows
            for seq, samples in zip(batch["seq"], batch["samples"])
        ]
        out = []
        for seq, chunk in sorted(arrived, key=itemgetter(0)):
            fault = "no sequence number" if seq == NO_SEQ else "no samples" if chunk is None else None
            if fault is None and last is not None and seq <= last:
                fault = "late"
            if fault is not None:
                number = None if seq == NO_SEQ else seq
                out.append((None, number, number, chunk, fault))
                continue
            last = seq
            buffer.append((seq, chunk))
            held += len(chunk)
            while held > self._max:
                extra = held - self._max
                first, samples = buffer.popleft()
                if len(samples) > extra:
                    buffer.appendleft((first, samples[extra:]))
                held -= min(extra, len(samples))
            if self._ready == "always" and held >= self._min:
                out.append(hand_over())
                emitted, held = emitted + 1, 0
            if len(out) >= ROWS_PER_FRAME:
                yield self._frame(key[0], out)
                out = []
        if out:
            yield self._frame(key[0], out)
        self._progress.update((last, emitted))
        self._chunks.put([(s, x.tobytes()) for s, x in buffer]) if buffer else self._chunks.clear()

    @staticmethod
    def _frame(sensor, rows: list[tuple]) -> pd.DataFrame:
        buffer, first, last, samples, rejected = zip(*rows)
        numbers = {n: pd.array(v, dtype="Int64") for n, v in (("buffer", buffer), ("first_seq", first), ("last_seq", last))}
        return pd.DataFrame({"sensor_id": [sensor] * len(rows), **numbers, "samples": samples, "rejected": rejected})

    def close(self) -> None:
        pass


def capture_stream(
    chunks: DataFrame,
    min_samples: int = CAPTURE_MIN_SECONDS * CAPTURE_RATE,
    max_samples: int = CAPTURE_MAX_SECONDS * CAPTURE_RATE,
    ready: str = "always",
    key_type: str = "STRING",
) -> DataFrame:
    """Filled buffers of a chunk stream (sensor_id, seq, samples), and the chunks that were rejected.

    `rejected` is null for a buffer, else the reason; samples keep their type. See `captured_clips`.
    """
    element = chunks.schema["samples"].dataType.elementType
    whole = F.when(~F.exists("samples", F.isnull), F.col("samples"))
    rows = chunks.select("sensor_id", F.coalesce("seq", F.lit(NO_SEQ)).alias("seq"), whole.alias("samples"))
    return rows.groupBy("sensor_id").transformWithStateInPandas(
        CaptureBuffer(min_samples, max_samples, ready, SAMPLE_TYPES[element.simpleString()]),
        f"sensor_id {key_type}, buffer BIGINT, first_seq BIGINT, last_seq BIGINT, "
        f"samples ARRAY<{element.simpleString()}>, rejected STRING",
        "Append",
        "None",
    )


def captured_clips(buffers: DataFrame, sample_rate: int = CAPTURE_RATE, n_channels: int = 1) -> DataFrame:
    """Buffers of int16 chunks as clips for detection; the clip's seq is that of its first chunk."""
    clips = buffers.where("rejected IS NULL").withColumnRenamed("first_seq", "seq").drop("rejected")
    return clips.withColumns({"sample_rate": F.lit(sample_rate), "n_channels": F.lit(n_channels)})


class RecentEvents(StatefulProcessor):
    """The newest `size` events of a sensor; the whole list is emitted after each change."""

    def __init__(self, size: int = 10) -> None:
        self._size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._events = handle.getListState("events", "ts TIMESTAMP, seq BIGINT, text STRING")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(r) for r in self._events.get()] if self._events.exists() else []
        before = list(kept)
        for batch in rows:
            kept += list(zip(batch["ts"], batch["seq"], batch["text"]))
            kept = sorted(kept, key=lambda e: (e[0], e[1]))[-self._size :]
        if kept == before:
            return
        self._events.put(kept)
        yield pd.DataFrame(
            [(key[0], rank, *event) for rank, event in enumerate(kept, 1)],
            columns=["sensor_id", "rank", "ts", "seq", "text"],
        )

    def close(self) -> None:
        pass


def recent_stream(events: DataFrame, size: int = 10, key_type: str = "STRING") -> DataFrame:
    """Live list of the newest events per sensor from (sensor_id, ts, seq, text)."""
    return events.select("sensor_id", "ts", "seq", "text").groupBy("sensor_id").transformWithStateInPandas(
        RecentEvents(size), f"sensor_id {key_type}, rank INT, ts TIMESTAMP, seq BIGINT, text STRING", "Update", "None"
    )
