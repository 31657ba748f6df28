"""Shared folder for written tables, and small local tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder.

    Only a local session without the setting falls back to a temporary folder;
    on a cluster that would be local to one machine, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="acoustic-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/acoustic-{uuid.uuid4().hex}/{name}"


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Driver rows as a local relation. Unlike a table from a Python list, its size is known to the planner."""
    columns = zip(*rows) if rows else [()] * len(schema)
    arrays = [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema.names), schema)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    The executors get it as a Python file. The driver-side worker of a stateful
    stream does not read those, so it gets the folder on its path.
    """
    root = Path(__file__).resolve().parent
    if spark.sparkContext.applicationId in _shipped:
        return
    _shipped.add(spark.sparkContext.applicationId)
    folder = tempfile.mkdtemp(prefix="acoustic-package-")
    package = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(package)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, str(root.parent)]))
