"""Keyed sensor messages as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from acoustic_spark.schemas import MESSAGES


def subscribe(
    spark: SparkSession, fmt: str = "kafka", schema: StructType | str | None = MESSAGES, path: str | None = None, **options: str
) -> DataFrame:
    """Subscribe to sensor messages: a topic in production, a folder of files otherwise.

    The topic connector brings its own schema, which is the message schema here.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka" and schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()
