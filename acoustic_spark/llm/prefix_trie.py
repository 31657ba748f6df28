"""The trie of conversations that begin alike, from sorted conversations and a range-minimum table.

Conversations are cut into segments of SEGMENT turns; a segment goes with the hash of all
turns before it, so no row grows with a conversation. Segments are range-sorted and packed
into blocks with the length of the prefix that each has in common with the one before it
(LCP). Within a block every candidate prefix finds its members by two binary searches, to
the left and to the right, over a sparse table of minima of the LCPs; none depends on another
and there is no stack. What a prefix counts is a sum over its members, so the blocks' parts are
added up by prefix: a prefix that a third of all conversations have costs one row a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustic_spark.llm.common import join_counted, written

SEGMENT = 64
#: Conversations that may take turns from the one whose id is theirs rounded down to this, and the most turns taken, plus one.
FAMILY, HEADS = 100, 6

BLOCK = "part int, block int, rows array<struct<conv:long,seg:long,size:int,more:boolean,after:long,b1:long,b2:long,lcp:int>>, x1 array<long>, x2 array<long>, chars array<long>, next_lcp int, head array<long>, tail array<long>"
PART = "depth long, h1 long, h2 long, p1 long, p2 long, conv long, n long, children long, leaves long, saved long, at long, ends string, seg long"
#: An LCP that is not known yet, as the neighbour is in another partition.
UNKNOWN = -2


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, pos, k1, k2, chars) for each turn, and (conv_id, part, before, size) for each partition of a conversation.

    Turns are range-sorted, so that a long conversation spreads over partitions. `pos` counts within
    the partition; `before` turns of the conversation are in earlier partitions, `size` in all.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), role_.alias("role"), F.md5(text_).alias("md5"),
        F.xxhash64(role_, text_).alias("k1"), F.xxhash64(F.lit(1), text_, role_).alias("k2"), F.length(text_).cast("long").alias("chars"),
    )
    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "md5"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.select("conv_id", "k1", "k2", "chars", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "turns")
    of_conv = Window.partitionBy("conv_id")
    earlier = of_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    runs = runs.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "size": F.sum("n").over(of_conv)})
    return placed, written(runs, "runs")


def rebuilt(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, size, k1, k2, chars): every conversation with its first turns taken from the first of its family.

    With h = crc32(conv_id) % HEADS, the first h turns of the conversation conv_id - conv_id % FAMILY (all if
    fewer, none if there is none) are followed by the conversation's own after its first h. One without a turn
    left has a single row with size 0 and nulls.
    """
    placed, runs = numbered(turns, conv_id, turn, role, text)
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = runs.where("before = 0").select("conv_id", "size", family.alias("family"), heads(F.col("conv_id")).alias("h"))
    first = sizes.where("conv_id = family").select("family", F.col("size").alias("of_first"))
    sizes = sizes.join(first, "family", "left").withColumn("taken", F.least("h", F.coalesce("of_first", F.lit(0))))
    sizes = sizes.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
    sizes = written(sizes.select("conv_id", "family", "h", "taken", "length"), "sizes")

    shifts = runs.join(sizes, "conv_id").select("conv_id", "part", (F.col("before") - F.col("first")).alias("shift"), "h", "taken", "length")
    own = placed.join(shifts, ["conv_id", "part"]).withColumn("rank", F.col("id") + F.col("shift"))
    columns = ["conv_id", "pos", F.col("length").alias("size"), "k1", "k2", "chars"]
    tails = own.where("rank >= h").withColumn("pos", F.col("taken") + F.col("rank") - F.col("h")).select(*columns)
    early = own.where((F.col("conv_id") == family) & (F.col("rank") < HEADS - 1)).select(family.alias("family"), F.col("rank").alias("pos"), "k1", "k2", "chars")
    starts = sizes.join(early, "family").where("pos < h").select(*columns)
    nothing = sizes.where("length = 0").select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("pos",)], F.lit(0).cast("long").alias("size"), *[F.lit(None).cast("long").alias(c) for c in ("k1", "k2", "chars")])
    return tails.unionByName(starts).unionByName(nothing)


def segments(turns: DataFrame) -> DataFrame:
    """(conv, seg, turns, more, after, b1, b2): up to SEGMENT turns with the hash of those before and the code points of those after."""
    at = turns.withColumns({"seg": F.floor(F.coalesce("pos", F.lit(0)) / SEGMENT), "x1": F.xxhash64("k1", "k2", "pos"), "x2": F.xxhash64("pos", "k2", "k1")})
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "x1", "x2", "chars"))
    parts = at.groupBy(F.col("conv_id").alias("conv"), "seg", "size").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    parts = parts.withColumn("more", (F.col("seg") + 1) * SEGMENT < F.col("size"))
    of_conv = Window.partitionBy("conv").orderBy("seg")

    def over(kind: str) -> Column:
        return F.aggregate(F.transform("turns", lambda t: t[kind]), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))

    long_ = parts.where(F.col("size") > SEGMENT).withColumns({"y1": over("x1"), "y2": over("x2"), "sum": F.aggregate(F.transform("turns", lambda t: t["chars"]), F.lit(0).cast("long"), lambda a, x: a + x)})
    earlier, later = of_conv.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    long_ = long_.select("conv", "seg", "turns", "more", *[F.coalesce(c, F.lit(0)).alias(n) for n, c in (("after", F.sum("sum").over(later)), ("b1", F.bit_xor("y1").over(earlier)), ("b2", F.bit_xor("y2").over(earlier)))])
    zero = F.lit(0).cast("long")
    return parts.where(F.col("size") <= SEGMENT).select("conv", "seg", "turns", "more", zero.alias("after"), zero.alias("b1"), zero.alias("b2")).unionByName(long_)


class Block:
    """Segments in sorted order, as arrays; two-dimensional ones have a column a turn."""

    def __init__(self, conv, seg, size, more, after, b1, b2, x1, x2, chars):
        self.conv, self.seg, self.size, self.more, self.after, self.b1, self.b2 = conv, seg, size, more, after, b1, b2
        self.there = np.arange(max(1, size.max())) < size[:, None]
        self.x1, self.x2, self.chars = (self._spread(v) for v in (x1, x2, chars))

    def _spread(self, flat: np.ndarray) -> np.ndarray:
        out = np.zeros(self.there.shape, np.int64)
        out[self.there] = flat
        return out

    def key(self, row: int) -> list[int]:
        n = self.size[row]
        return [int(v) for v in (self.seg[row], self.b1[row], self.b2[row], *self.x1[row, :n], *self.x2[row, :n])]

    def lcps(self) -> np.ndarray:
        """Turns that each row but the first has in common with the one before it; -1 if those before the segment differ."""
        same = (self.x1[1:] == self.x1[:-1]) & (self.x2[1:] == self.x2[:-1]) & self.there[1:] & self.there[:-1]
        group = (self.seg[1:] == self.seg[:-1]) & (self.b1[1:] == self.b1[:-1]) & (self.b2[1:] == self.b2[:-1])
        return np.where(group, np.logical_and.accumulate(same, axis=1).sum(axis=1), -1)


def common(a: list[int] | None, b: list[int] | None) -> int:
    """LCP of two keys of Block.key; -1 if one is missing or they belong to different prefixes."""
    if a is None or b is None or list(a[:3]) != list(b[:3]):
        return -1
    n, m = (len(a) - 3) // 2, (len(b) - 3) // 2
    lcp = 0
    while lcp < min(n, m) and a[3 + lcp] == b[3 + lcp] and a[3 + n + lcp] == b[3 + m + lcp]:
        lcp += 1
    return lcp


def _flat(column: pa.Array, name: str) -> np.ndarray:
    return column.flatten().field(name).to_numpy()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition, one a batch; each waits for the next to know the LCP across."""

    def packed(part: int, number: int, b: Block, lcp: np.ndarray, next_lcp: int) -> pa.RecordBatch:
        rows = [dict(zip(("conv", "seg", "size", "more", "after", "b1", "b2", "lcp"), v)) for v in zip(*(x.tolist() for x in (b.conv, b.seg, b.size, b.more, b.after, b.b1, b.b2, lcp)))]
        values = [part, number, rows, b.x1[b.there], b.x2[b.there], b.chars[b.there], next_lcp, b.key(0), b.key(-1)]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.struct([("conv", pa.int64()), ("seg", pa.int64()), ("size", pa.int32()), ("more", pa.bool_()), ("after", pa.int64()), ("b1", pa.int64()), ("b2", pa.int64()), ("lcp", pa.int32())])), *[pa.list_(pa.int64())] * 3, pa.int32(), *[pa.list_(pa.int64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["part", "block", "rows", "x1", "x2", "chars", "next_lcp", "head", "tail"])

    open_, number = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        of = lambda c: batch[c].to_numpy(zero_copy_only=False)
        turns = batch["turns"]
        size = np.diff(turns.offsets.to_numpy()).astype(np.int32)
        block = Block(of("conv"), of("seg"), size, of("more"), of("after"), of("b1"), of("b2"), *(_flat(turns, c) for c in ("x1", "x2", "chars")))
        first = UNKNOWN if open_ is None else common(open_[2].key(-1), block.key(0))
        if open_ is not None:
            yield packed(*open_, first)
        open_ = (int(batch["part"][0].as_py()), number, block, np.append(first, block.lcps()))
        number += 1
    if open_ is not None:
        yield packed(*open_, UNKNOWN)


class Minima:
    """Sparse table of range minima: level k holds the minimum of 2**k values from each place on."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Minimum of each range begin <= i < end, none empty."""
        k = np.log2(end - begin).astype(int)
        out = np.empty(len(begin), self.levels[0].dtype)
        for level in np.unique(k):
            of = k == level
            out[of] = np.minimum(self.levels[level][begin[of]], self.levels[level][end[of] - (1 << level)])
        return out

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place after `at` whose value is under `depth`, or the end: a binary search for each."""
        place = at + 1
        for k in range(len(self.levels) - 1, -1, -1):
            fits = place + (1 << k) <= len(self.levels[0])
            go = fits & (self.levels[k][np.where(fits, place, 0)] >= depth)
            place = place + (go << k)
        return place

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to `at` whose value is under `depth` (the first place has one)."""
        place = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            begin = place - (1 << k) + 1
            go = (begin >= 0) & (self.levels[k][np.maximum(begin, 0)] >= depth)
            place = place - (go << k)
        return place


def block_nodes(b: Block, lcp: np.ndarray, next_lcp: int) -> tuple[dict[str, np.ndarray], list[str | None], np.ndarray, np.ndarray]:
    """Parts of the prefixes of a block: columns of PART, ends; and of each row the code points it has first and whether it ends a leaf.

    A prefix counts as new in the row whose LCP is smaller, over all blocks; a row is a leaf's last
    one if the conversation ends there and the next row does not have all its turns.
    """
    n = len(b.conv)
    zeros = np.zeros((n, 1), np.int64)
    cum = np.concatenate([zeros, np.cumsum(b.chars, axis=1)], axis=1)
    n1, n2 = (np.concatenate([x0[:, None], x0[:, None] ^ np.bitwise_xor.accumulate(x, axis=1)], axis=1) for x0, x in ((b.b1, b.x1), (b.b2, b.x2)))
    total = cum[np.arange(n), b.size]
    own = total - cum[np.arange(n), np.maximum(lcp, 0)]
    leaf = ~b.more & (np.append(lcp[1:], next_lcp) < b.size)

    inside = lcp.copy()
    inside[0] = -1
    minima, smallest = Minima(inside), Minima(b.conv)
    many = b.size - inside
    row = np.repeat(np.arange(n), many)
    begin = np.cumsum(many) - many
    depth = np.arange(len(row)) - begin[row] + inside[row] + 1
    left, right = minima.left(row, depth), minima.right(row, depth)

    sums = {k: np.append(0, np.cumsum(v)) for k, v in (("chars", total + b.after), ("own", own), ("leaf", leaf.astype(np.int64)))}
    between = {k: v[right] - v[left] for k, v in sums.items()}
    members = between["chars"] - (right - left) * cum[row, np.maximum(depth - 1, 0)]
    # The first row's own turns count from the depth on only.
    first = between["own"] - own[left] + total[left] - cum[left, np.maximum(np.maximum(depth - 1, lcp[left]), 0)]

    new = depth > np.maximum(lcp[row], 0)
    parent_row = np.where(depth - 1 > inside[row], row, minima.left(row, np.maximum(depth - 1, 0)))
    parent = begin[parent_row] + (depth - 1) - inside[parent_row] - 1
    children = np.bincount(parent[new], minlength=len(row))

    same = np.append(False, (inside[1:] == b.size[1:]) & (b.size[:-1] == b.size[1:]) & ~b.more[1:] & ~b.more[:-1])
    stops = np.flatnonzero(~same)
    run_end = np.append(stops, n)[np.searchsorted(stops, np.arange(n), "right")]
    ending = (depth == b.size[row]) & ~b.more[row]
    before = (depth == 0) & (b.seg[row] > 0)  # belongs to the segment before; here only its children are new
    ending &= ~before
    ids = b.conv.astype(str)
    ends: list[str | None] = [None] * len(row)
    for i in np.flatnonzero(ending):
        ends[i] = ",".join(ids[row[i] : run_end[row[i]]])
    up = np.maximum(depth - 1, 0)
    columns = {
        "depth": b.seg[row] * SEGMENT + depth, "h1": n1[row, depth], "h2": n2[row, depth], "p1": n1[row, up], "p2": n2[row, up],
        "conv": np.where(before, np.iinfo(np.int64).max, smallest.least(left, right)), "n": np.where(before, 0, right - left),
        "children": children, "leaves": np.where(before, 0, between["leaf"]), "saved": np.where(before, 0, members - first),
    }
    return columns, ends, own, leaf


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of prefixes, and for segments of long conversations a row (seg, conv, saved = new code points, leaves)."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            rows = one["rows"].flatten()
            of = {c: rows.field(c).to_numpy(zero_copy_only=False) for c in ("conv", "seg", "size", "more", "after", "b1", "b2", "lcp")}
            lcp = of.pop("lcp").astype(np.int64)
            block = Block(**of, **{c: one[c].flatten().to_numpy() for c in ("x1", "x2", "chars")})
            head, tail, next_lcp = (one[c][0].as_py() for c in ("head", "tail", "next_lcp"))
            if lcp[0] == UNKNOWN:
                lcp[0] = common(one["before"][0].as_py(), head)
            if next_lcp == UNKNOWN:
                next_lcp = common(tail, one["behind"][0].as_py())
            columns, ends, own, leaf = block_nodes(block, lcp, next_lcp)
            n = len(ends)
            at = (one["part"][0].as_py() << 32) + one["block"][0].as_py()
            long_ = (block.seg > 0) | block.more
            m = int(long_.sum())
            blank = pa.nulls(m, pa.int64())
            extra = {"conv": pa.array(block.conv[long_]), "leaves": pa.array(leaf[long_].astype(np.int64)), "saved": pa.array(own[long_])}
            out = [pa.concat_arrays([pa.array(v.astype(np.int64)), extra.get(c, blank)]) for c, v in columns.items()]
            out += [pa.array([at] * n + [None] * m, pa.int64()), pa.array(ends + [None] * m, pa.string()), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(block.seg[long_])])]
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "at", "ends", "seg"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the pieces of each prefix, from rows sorted by prefix and place; holds one hash state."""
    last, state = None, None
    for batch in batches:
        out = []
        for *key, piece in zip(batch["depth"], batch["h1"], batch["h2"], batch["ends"]):
            if key != last:
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pd.DataFrame(out, columns=["depth", "h1", "h2", "ends_sha256"])
    if last is not None:
        yield pd.DataFrame([(*last, state.hexdigest())], columns=["depth", "h1", "h2", "ends_sha256"])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes that end within a segment, each with what later segments of the conversation add."""
    for batch in batches:
        for row in batch.to_pylist():
            x = np.array([[t["x1"], t["x2"]] for t in row["turns"]], np.int64)
            path = np.bitwise_xor.accumulate(x, axis=0) ^ np.array([row["b1"], row["b2"]], np.int64)
            depth = row["seg"] * SEGMENT + np.arange(1, len(x) + 1)
            if not row["seg"]:
                path, depth = np.concatenate([[[0, 0]], path]), np.append(0, depth)
            columns = [depth.astype(np.int64), path[:, 0], path[:, 1], np.full(len(depth), row["leaves"]), np.full(len(depth), -row["own"])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["depth", "h1", "h2", "leaves", "saved"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each distinct prefix of conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `turns` has conv_id, pos (from 0), size (turns of the conversation), two hashes k1 and k2 of the turn and its chars, as
    `rebuilt` gives them; a conversation without turns is one row of size 0. conv_id is the smallest member, parent_conv_id that
    of the prefix with one turn less (null for the prefix of no turns, which all have). n_leaves counts prefixes in the
    subtree that no conversation goes on from; saved_tokens is the sum over the subtree of the code points of
    a prefix's last turn times its members but one; ends_sha256 hashes the ids of the members that end there, in ascending
    order. Prefixes are told apart by 128 bits. Equal conversations are members each. No rows give no prefixes.
    """
    rows = written(segments(turns), "segments")
    key = F.flatten(F.transform("turns", lambda t: F.array(t["x1"], t["x2"])))
    order = ["seg", "b1", "b2", "key", "more", "conv"]
    sorted_ = rows.withColumn("key", key).repartitionByRange(*order).sortWithinPartitions(*order).drop("key").withColumn("part", F.spark_partition_id())
    blocks = written(sorted_.mapInArrow(_pack, BLOCK), "blocks")
    # Neighbours across partitions: two rows a partition at most.
    ends = blocks.groupBy("part").agg(F.max("block").alias("last"), F.min_by("head", "block").alias("head"), F.max_by("tail", "block").alias("tail"))
    line = Window.partitionBy(F.lit(0)).orderBy("part")
    ends = ends.select("part", F.lag("tail").over(line).alias("before"), F.lead("head").over(line).alias("behind"))
    parts = written(blocks.join(ends, "part").mapInArrow(_nodes, PART), "nodes")

    found = parts.where("seg is null")
    later = Window.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    deeper = parts.where("seg is not null").select("conv", "seg", F.sum("saved").over(later).alias("own"), F.sum("leaves").over(later).alias("leaves")).where("own is not null")
    more = rows.where("more").join(deeper, ["conv", "seg"]).mapInArrow(_paths, "depth long, h1 long, h2 long, leaves long, saved long")
    none = F.lit(None).cast("long")
    more = more.select("depth", "h1", "h2", none.alias("p1"), none.alias("p2"), none.alias("conv"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("children"), "leaves", "saved")
    parent = F.struct("p1", "p2")
    node = found.select(*more.columns).unionByName(more).groupBy("depth", "h1", "h2").agg(
        F.min(F.when(F.col("n") > 0, parent)).alias("up"), F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
    )
    pieces = found.where("ends is not null").select("depth", "h1", "h2", "at", "ends").repartition("depth", "h1", "h2").sortWithinPartitions("depth", "h1", "h2", "at")
    digests = pieces.mapInPandas(_digests, "depth long, h1 long, h2 long, ends_sha256 string")
    node = node.join(digests, ["depth", "h1", "h2"], "left").na.fill({"ends_sha256": hashlib.sha256(b"").hexdigest()})
    node = written(node, "prefixes")

    parents = node.where("n_children > 0").select(F.struct("depth", "h1", "h2").alias("above"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    below = node.where("depth > 0").withColumn("above", F.struct((F.col("depth") - 1).alias("depth"), F.col("up.p1").alias("h1"), F.col("up.p2").alias("h2"))).withColumnRenamed("n_children", "children")
    joined = join_counted(below, parents, "above", "n_children", node.count()).drop("n_children").withColumnRenamed("children", "n_children")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = node.where("depth = 0").withColumn("parent_conv_id", none)
    return joined.select(*columns).unionByName(top.select(*columns))
