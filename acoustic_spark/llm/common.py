"""Helpers shared by the text operators: written tables, row keys, skew-safe joins, bounded filters."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce, wraps
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: what separates words in all contracts of this package (ASCII white space).
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A key that holds at least this share of all rows is "hot"; there are at most 1 / HOT_SHARE such keys.
HOT_SHARE = 1 / 1000

BITMAP_BITS = 32768
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 18, 1 << 30

#: Bytes of a batch of rows on their way to Python, one row at least. Each running task of an executor holds several
#: copies of one: as vectors and as a stream outside the heap, as a stream and as objects in its Python worker.
BATCH_BYTES = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all executors share.

    Only a one-process local session without the setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, lineage cut, safe against lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def bound_batches(spark: SparkSession) -> str:
    """Lowers the session's bound of a batch to BATCH_BYTES, if it is larger, and gives the one it had."""
    before = spark.conf.get(BATCH_SETTING)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within send whole texts to Python in batches of BATCH_BYTES; the session's setting comes back after them."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def in_small_batches(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function of a table with all jobs that it runs itself in `small_batches`."""

    @wraps(run)
    def bounded(df: DataFrame, *args, **named):
        with small_batches(df.sparkSession):
            return run(df, *args, **named)

    return bounded


def discard(*tables: DataFrame) -> None:
    """Deletes the folders of written tables that nothing reads any more."""
    for table in tables:
        jvm, session = table.sparkSession._jvm, table.sparkSession._jsparkSession
        path = jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names with a prefix of underscores that makes none of them clash with a column of df (case ignored)."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any((prefix + n).lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def join_counted(df: DataFrame, counts: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """Inner join of df with a table of one row per key that says how many rows of df the key has.

    Hot keys are joined by broadcast: there are at most 1 / HOT_SHARE of them, so the
    size is bounded whatever the data. Others are joined by shuffle, none of them large.
    `total` is the number of rows that the shares are taken of.
    """
    limit = max(1.0, total * HOT_SHARE)
    hot, rest = counts.where(F.col(n) >= limit), counts.where(F.col(n) < limit)
    cold = df.join(F.broadcast(hot.select(key)), key, "left_anti")
    return df.join(F.broadcast(hot), key).unionByName(cold.join(rest, key))


def filter_bits(n_rows: int) -> int:
    """Bits of a repeat filter: a power of two, sixteen or more a row between fixed bounds (at most 128 MB)."""
    bits = MIN_FILTER_BITS
    while bits < 16 * n_rows and bits < MAX_FILTER_BITS:
        bits *= 2
    return bits


def repeat_filter(hashes: DataFrame, columns: list[str], n_rows: int) -> DataFrame:
    """First pass of the two-pass Bloom filter: bitmaps of the slots that two or more rows set.

    Each of `columns` (independent 64-bit hashes of the value) sets one slot a row. The
    result (bucket, bits) has at most filter_bits(n_rows) / 32768 rows of 4 KB for each column.
    """
    bits = filter_bits(n_rows)
    slots = hashes.select(F.explode(F.array(*[F.col(c).bitwiseAND(F.lit(bits - 1)) + F.lit(i * bits) for i, c in enumerate(columns)])).alias("slot"))
    twice = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # bitmap_* number positions from 1, so slot + 1 has bucket slot div 32768 + 1 and bit slot mod 32768.
    one = twice.withColumn("slot", F.col("slot") + 1)
    return one.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def bit_set(bitmap: Column, position: Column) -> Column:
    """Whether the bit is set in a bitmap of bitmap_construct_agg; a null bitmap has none."""
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1))
    return F.coalesce(bit == 1, F.lit(False))


def maybe_repeated(df: DataFrame, bitmaps: DataFrame, columns: list[str], n_rows: int, flag: str) -> DataFrame:
    """Second pass: df with `flag`, true if every slot of the row is one that two or more rows set.

    A row whose value another row has is always flagged; a row of a single value rarely.
    Each column's bitmaps are broadcast, MAX_FILTER_BITS at most (128 MB). Beyond MAX_FILTER_BITS / 16
    rows the slots fill up and more rows of single values are flagged, which costs their shuffle but no result.
    """
    bits = filter_bits(n_rows)
    flags = []
    for i, c in enumerate(columns):
        bucket, found, slot = fresh(df, f"bucket{i}", f"bits{i}", f"slot{i}")
        of_column = F.col("bucket").between(i * bits // BITMAP_BITS + 1, (i + 1) * bits // BITMAP_BITS)
        side = F.broadcast(bitmaps.where(of_column).select(F.col("bucket").alias(bucket), F.col("bits").alias(found)))
        df = df.withColumn(slot, F.col(c).bitwiseAND(F.lit(bits - 1)) + F.lit(i * bits + 1))
        df = df.join(side, F.bitmap_bucket_number(slot) == F.col(bucket), "left")
        df = df.withColumn(slot, bit_set(F.col(found), F.bitmap_bit_position(slot))).drop(bucket, found)
        flags.append(slot)
    keep = [c for c in df.columns if c not in flags]
    return df.select(*[df[c] for c in keep], reduce(and_, map(F.col, flags)).alias(flag))
