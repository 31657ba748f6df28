"""Line deduplication by a sharded minimal perfect hash.

Lines are counted by the 128-bit hash of their key. The hashes that enough documents hold are
dealt into shards; each shard gets a minimal perfect hash, which gives every one of its hashes
a place in three compact arrays: fingerprint, count, and the largest document that holds it.
Documents then probe the arrays: what moves is 16 bytes for each long line of a slice of
documents, and a shard's arrays, never a line. A probe whose fingerprint differs is not in the
shard, so a line goes only if all 128 bits are those of a repeated one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from acoustic_spark.llm.common import fresh, text_or_empty, written
from acoustic_spark.llm.jaccard import mix64

#: Code points of a key and documents that hold it, at least, for its lines to go.
LEAST_CHARS, LEAST_DOCS = 20, 3
#: Fixed value: what is stripped from a line (ASCII white space).
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Entries (a line of a document) that a slice of documents gathers before it passes them on.
SLICE = 1 << 17
#: Hashes of a shard on average, and rows that probe a shard's arrays in one group.
SHARD_KEYS, PROBES = 1 << 16, 1 << 18
#: Slots for each hash at each level of the perfect hash.
ROOM = 2

STEP = np.uint64(0x9E3779B97F4A7C15)
LINES = "hi long, lo long, n long, last long, slice int, ids array<long>, texts array<long>"
ARRAYS = "shard long, sizes array<long>, bits binary, fingerprints binary, counts binary, last binary, no_last binary"

KEPT = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])


def line_keys(text: str) -> list[bytes]:
    """The key of each line: ASCII white space stripped at both ends, A-Z in lower case."""
    return [line.strip(BLANK) for line in text.encode().lower().split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has so many code points."""
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def slots(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(lo ^ mix64(hi + STEP * np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit hashes, in levels.

    At each level a hash that has a slot for itself takes it, the others go to the next
    level. A hash's place is the number of taken slots before its own, over all levels.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.words = sizes, bits.view(np.uint64)
        taken = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(taken) - taken

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(hi):
            size = -(-ROOM * len(hi) // 64) * 64
            slot = slots(hi, lo, len(sizes), size)
            alone = np.bincount(slot, minlength=size)[slot] == 1
            bits = np.zeros(size, np.uint8)
            bits[slot[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little"))
            sizes.append(size)
            hi, lo = hi[~alone], lo[~alone]
        return cls(sizes, np.concatenate(levels) if levels else np.empty(0, np.uint8))

    def places(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Place of each hash, each of 0 .. n - 1 once for the hashes of the build; another hash gets any place, or -1."""
        out = np.full(len(hi), -1, np.int64)
        left, offset = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes):
            slot = slots(hi[left], lo[left], level, size) + offset
            word, bit = self.words[slot >> 6], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[slot >> 6] + np.bitwise_count(below))[hit]
            left, offset = left[~hit], offset + size
        return out


def _lines(least: int) -> object:
    """(doc_id, th, text) to the long lines of a slice of documents: each hash once, with the documents that hold it."""

    def table(hi: list, lo: list, doc: list, ids: list, texts: list, slice_: int) -> pa.RecordBatch:
        hi, lo, doc = (np.concatenate(x) if x else np.empty(0, kind) for x, kind in ((hi, np.uint64), (lo, np.uint64), (doc, np.int64)))
        order = np.lexsort((lo, hi))
        hi, lo, doc = hi[order], lo[order], doc[order]
        start = np.flatnonzero(np.append(True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))) if len(hi) else np.empty(0, np.int64)
        ends = np.append(start, len(hi)).astype(np.int32)
        known = np.array([i is not None for i in ids], bool)
        values = np.array([i or 0 for i in ids], np.int64)
        least_id = np.iinfo(np.int64).min
        last = np.maximum.reduceat(np.where(known, values, least_id)[doc], start) if len(start) else start
        none = ~np.logical_or.reduceat(known[doc], start) if len(start) else np.empty(0, bool)
        lists = [pa.ListArray.from_arrays(pa.array(ends), x) for x in (pa.array(values[doc], mask=~known[doc]), pa.array(np.array(texts, np.int64)[doc]))]
        columns = [pa.array(hi[start].view(np.int64)), pa.array(lo[start].view(np.int64)), pa.array(np.diff(ends).astype(np.int64)), pa.array(last, mask=none)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(start), slice_, np.int32)), *lists], names=["hi", "lo", "n", "last", "slice", "ids", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hi, lo, doc, ids, texts, n = [], [], [], [], [], 0
        for batch in batches:
            for i, th, text in zip(batch["doc_id"].to_pylist(), batch["th"].to_pylist(), batch["text"]):
                keys = [k for k in set(line_keys(text.as_py())) if long_enough(k, least)]
                for begin in range(0, len(keys), SLICE):  # a very long document goes in several slices
                    part = keys[begin : begin + SLICE]
                    if n + len(part) > SLICE:
                        yield table(hi, lo, doc, ids, texts, (th or 0) & 0x7FFFFFFF)
                        hi, lo, doc, ids, texts, n = [], [], [], [], [], 0
                    h, g = key_hashes(part)
                    hi.append(h)
                    lo.append(g)
                    doc.append(np.full(len(part), len(ids)))
                    ids.append(i)
                    texts.append(th)
                    n += len(part)
        yield table(hi, lo, doc, ids, texts, texts[-1] & 0x7FFFFFFF if texts else 0)

    return run


def _arrays(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: its perfect hash and the arrays in the order of the places."""
    hi, lo = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("hi", "lo"))
    perfect = PerfectHash.build(hi, lo)
    order = np.argsort(perfect.places(hi, lo))
    counts = np.minimum(rows["n"].to_numpy(), 0xFFFFFFFF).astype(np.uint32)[order]
    none = rows["last"].isna().to_numpy()[order]
    last = rows["last"].astype("Int64").fillna(0).to_numpy(np.int64)[order]
    return pd.DataFrame({
        "shard": [rows["shard"].iloc[0]], "sizes": [perfect.sizes], "bits": [perfect.words.tobytes()],
        "fingerprints": [hi[order].tobytes()], "counts": [counts.tobytes()], "last": [last.tobytes()], "no_last": [none.tobytes()],
    })


def _probe(least: int) -> object:
    """Lines of a shard against its arrays: (doc_id, th, hi, lo) of each document that loses the line."""

    def run(lines: pa.Table, arrays: pa.Table) -> pa.Table:
        lines = lines.combine_chunks()
        names = ["doc_id", "th", "hi", "lo"]
        if not arrays.num_rows or not lines.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names=names)
        shard = {c: arrays[c][0].as_py() for c in arrays.column_names}
        perfect = PerfectHash(shard["sizes"], np.frombuffer(shard["bits"], np.uint8))
        hi, lo = (lines[c].to_numpy().view(np.uint64) for c in ("hi", "lo"))
        place = perfect.places(hi, lo)
        hit = (place >= 0) & (np.frombuffer(shard["fingerprints"], np.uint64)[place] == hi) & (np.frombuffer(shard["counts"], np.uint32)[place] >= least)
        found = lines.filter(pa.array(hit))
        ids, texts = (found[c].combine_chunks() for c in ("ids", "texts"))
        each = np.repeat(np.flatnonzero(hit), np.diff(ids.offsets.to_numpy()))
        doc = ids.flatten()
        no_id = doc.is_null().to_numpy(zero_copy_only=False)
        last, none = np.frombuffer(shard["last"], np.int64)[place[each]], np.frombuffer(shard["no_last"], bool)[place[each]]
        stays = np.where(no_id, none, ~none & (doc.fill_null(0).to_numpy() == last))
        goes = pa.array(~stays)
        rest = [pa.array(x[each].view(np.int64)) for x in (hi, lo)]
        return pa.table([c.filter(goes) for c in (doc, texts.flatten(), *rest)], names=names)

    return run


def repeated_lines(docs: DataFrame, least_chars: int, least_docs: int) -> DataFrame:
    """(doc_id, th, gone): for each (doc_id, th) of docs (doc_id, th, text) that loses lines, their hashes (hi, lo), once each."""
    lines = written(docs.mapInArrow(_lines(least_chars), LINES), "lines")
    keys = lines.groupBy("hi", "lo").agg(F.sum("n").alias("n"), F.max("last").alias("last")).where(F.col("n") >= least_docs)
    keys = written(keys, "keys")
    n_keys, n_lines = keys.count(), lines.count()
    shards = 1 << max(0, (n_keys // SHARD_KEYS).bit_length())
    salts = -(-n_lines // (shards * PROBES)) or 1
    shard = F.pmod("lo", F.lit(shards)).alias("shard")
    arrays = written(keys.select("hi", "lo", "n", "last", shard).groupBy("shard").applyInPandas(_arrays, ARRAYS), "arrays")
    salted = arrays.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    probes = lines.select("hi", "lo", "ids", "texts", shard, F.pmod(F.xxhash64("slice"), F.lit(salts)).alias("salt"))
    found = probes.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInArrow(_probe(least_docs), "doc_id long, th long, hi long, lo long")
    return found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("hi", "lo")).alias("gone"))


@F.pandas_udf(KEPT)
def _without(text: pd.Series, gone: pd.Series) -> pd.DataFrame:
    rows = []
    for whole, hashes in zip(text, gone):
        lines = whole.split("\n")
        kept = lines
        if hashes is not None and len(hashes):
            out = {(h["hi"], h["lo"]) for h in hashes}
            hi, lo = key_hashes(line_keys(whole))
            kept = [x for x, *h in zip(lines, hi.view(np.int64).tolist(), lo.view(np.int64).tolist()) if tuple(h) not in out]
        rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept_text"])


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """`docs` with n_lines, n_dropped and kept_text.

    A text is split at \\n; null counts as empty, which is one empty line. A line's key has
    ASCII white space stripped at both ends and A-Z in lower case. Keys of `least_chars` code points or more
    that `least_docs` rows or more hold (a row counts once however often it repeats the line) lose all their
    lines, except in the largest doc_id that holds them, where all stay. Every row counts as a document, also one that repeats a
    doc_id; rows that share the largest doc_id all keep their lines. A null doc_id is smaller than all
    others. Other lines stay, joined by \\n; a text of which nothing stays is empty. An empty table gives an empty result. Result
    columns replace input columns of the same name; all others stay.
    """
    added = ["n_lines", "n_dropped", "kept_text"]
    docs = docs.drop(*[c for c in added if c not in (text, doc_id)])
    th, did, whole, gone_id, gone_th, gone, out = fresh(docs, "th", "did", "whole", "gone_id", "gone_th", "gone", "out")
    docs = docs.withColumns({did: F.col(doc_id).cast("long"), whole: text_or_empty(text)}).withColumn(th, F.xxhash64(whole))
    narrow = docs.select(F.col(did).alias("doc_id"), F.col(th).alias("th"), F.col(whole).alias("text"))
    lost = repeated_lines(narrow, least_chars, least_docs).select(F.col("doc_id").alias(gone_id), F.col("th").alias(gone_th), F.col("gone").alias(gone))
    joined = docs.join(lost, F.col(did).eqNullSafe(F.col(gone_id)) & (F.col(th) == F.col(gone_th)), "left")
    done = joined.withColumn(out, _without(F.col(whole), F.col(gone)))
    keep = [c for c in docs.columns if c not in (th, did, whole, *added)]
    return done.select(*keep, *[F.col(f"{out}.{c}").alias(c) for c in added])
