"""Removal of repeated passages by a depth-limited radix sort of suffixes.

A suffix matters up to its first LENGTH bytes, its window. Windows are sorted by digits of
their content, the most significant digit first; a group of one drops out, and windows
that are together to the last digit are equal. Three things keep the sort small:

- The first digit is the window's smallest hashed ANCHOR-gram with its place in the
  window. Equal windows have equal ones, and neighbouring windows mostly share one, so a
  run of neighbours is one row.
- A run whose whole content an earlier run of its group has is decided at once, for all
  its windows. Only the first run of each content goes on, and only if its group has
  other contents.
- Such runs are cut by places into cells, four at a time. The next digit is what all
  windows of a cell have in common, and at the last digit a cell is one window.

Each pass is one shuffle by digit and a sort within tasks; rows stream through a task, so
a large group is never held.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.llm.common import text_or_empty, written

LENGTH, ANCHOR = 100, 24
PLACES = LENGTH - ANCHOR + 1
#: Places in a cell at each pass after the first.
CELLS = (20, 5, 1)
#: Bytes of text that a task hashes in one step; longer texts are cut into overlapping pieces.
CHUNK = 1 << 22
POSITION_BITS = 23

#: Fixed values of the hash: an odd base, its inverse modulo 2**64, and a number for each byte.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTES = np.random.default_rng(1).integers(0, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

ROW = "kind int, key long, whole long, doc long, place long"
#: A row is decided (its windows are repeated) or open.
DECIDED, OPEN = 0, 1


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


# A place packs the text's mark (18 bits), the anchor's byte position (31), and the first and last offset of the anchor in the run's windows (7 each).
def packed(mark, position, low, high):
    return (((mark << 31 | position) << 7) | low) << 7 | high


def unpacked(place):
    return place >> 45, place >> 14 & 0x7FFFFFFF, place >> 7 & 127, place & 127


def mark_of(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 18) - 1))


class Powers:
    """Powers of the base and of its inverse, as many as were ever needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.append(np.uint64(1), np.full(size - 1, BASE, np.uint64)))
            self.down = np.cumprod(np.append(np.uint64(1), np.full(size - 1, INVERSE, np.uint64)))
        return self.up[:n], self.down[:n]


def runs(text: np.ndarray, ends: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts that lie one behind the other: (anchor hash, content hash, anchor position, lowest and highest offset).

    `ends` are the ends of the texts; windows do not cross them.
    """
    n = len(text)
    if n < LENGTH:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    up, down = powers.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTES[text] * up, out=sums[1:])
    grams = mix64((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: n - ANCHOR + 1])
    mask = np.uint64((1 << POSITION_BITS) - 1)
    # Smallest hash of PLACES grams, the leftmost of equal ones, by doubling.
    least = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < PLACES:
        least = np.minimum(least[: len(least) - (PLACES - width)], least[PLACES - width :])
    starts = np.append(0, ends[:-1])
    inside = np.zeros(n + 1, np.int32)
    long_ = ends - starts >= LENGTH
    np.add.at(inside, starts[long_], 1)
    np.add.at(inside, ends[long_] - LENGTH + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[: len(least)]))
    if not len(valid):
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    at = (least[valid] & mask).astype(np.int64)
    cut = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    first, last = valid[cut], valid[np.append(cut[1:], len(valid)) - 1]
    at = at[cut]
    low, high = at - last, at - first
    whole = mix64((sums[last + LENGTH] - sums[first]) * down[first])
    whole = mix64(whole ^ ((low << 7 | high).astype(np.uint64) * M1))
    return grams[at], whole, at, low, high


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, int, int, bytes]]:
    """(doc, mark, first byte, bytes): each text, in overlapping pieces if it is very long."""
    for batch in batches:
        for doc, mark, text in zip(batch["doc"], batch["mark"], batch["text"]):
            data = text.encode()
            for base in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
                yield doc, mark, base, data[base : base + CHUNK + LENGTH - 1]


def _frame(kind, key, whole, doc, place) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.asarray(kind, np.int32), "key": key.astype(np.uint64).view(np.int64), "whole": whole.astype(np.uint64).view(np.int64), "doc": doc, "place": place})


def _first_digit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of all runs; those whose content an earlier run of the same step has are decided here and never meet the others."""
    powers = Powers()

    def of(part: list[tuple[int, int, int, bytes]]) -> pd.DataFrame:
        text = np.frombuffer(b"".join(p[3] for p in part), np.uint8)
        length = np.array([len(p[3]) for p in part], np.int64)
        ends = np.cumsum(length)
        key, whole, at, low, high = runs(text, ends, powers)
        of_part = np.searchsorted(ends, at, side="right")
        doc = np.array([p[0] for p in part], np.int64)[of_part]
        mark = np.array([p[1] for p in part], np.int64)[of_part]
        base = np.array([p[2] for p in part], np.int64)[of_part]
        place = packed(mark, at - (ends - length)[of_part] + base, low, high)
        order = np.lexsort((place, doc, whole, key))
        key, whole, doc, place = key[order], whole[order], doc[order], place[order]
        new = np.append(True, (key[1:] != key[:-1]) | (whole[1:] != whole[:-1]))[: len(key)]
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        other = (doc != doc[head]) | (place != place[head])
        kind = np.where(new, OPEN, DECIDED)
        keep = new | other
        # Decided rows only pass through; they are dealt out by document.
        key = np.where(new, key, mix64(doc.astype(np.uint64)))
        return _frame(kind[keep], key[keep], whole[keep], doc[keep], place[keep])

    part, size = [], 0
    for segment in _segments(batches):
        if size + len(segment[3]) > CHUNK + LENGTH and part:
            yield of(part)
            part, size = [], 0
        part.append(segment)
        size += len(segment[3])
    if part:
        yield of(part)


def children(doc: int, place: int, context: bytes, cell: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """The run's parts in cells of so many places: (next digit, content hash, doc, place, context).

    `context` is the run's content. All windows of a cell contain what lies between the
    last window's start and the first one's end; its hash and the cell are the digit.
    """
    mark, position, low, high = unpacked(place)
    for first in range(low - low % cell, high + 1, cell):
        last = min(first + cell, PLACES) - 1
        a, b = max(first, low), min(last, high)
        # Offsets in the context, which starts at position - high.
        common = context[high - first : high + LENGTH - last]
        content = context[high - b : high + LENGTH - a]
        key = xxhash.xxh3_64_intdigest(common, seed=first << 8 | cell)
        whole = xxhash.xxh3_64_intdigest(content, seed=1 << 32 | a << 8 | b)
        yield key, whole, doc, packed(mark, position, a, b), content


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _child_frame(rows: list[tuple]) -> pd.DataFrame:
    key, whole, doc, place, context = zip(*rows) if rows else ([], [], [], [], [])
    return pd.DataFrame({"kind": np.full(len(doc), OPEN, np.int32), "key": _signed(list(key)), "whole": _signed(list(whole)), "doc": np.array(doc, np.int64), "place": np.array(place, np.int64), "context": list(context)})


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Open rows of a document with its text: their children for the second digit."""
    for batch in batches:
        rows = []
        for doc, places, text in zip(batch["doc"], batch["places"], batch["packed"]):
            data = zlib.decompress(text)
            for place in places.tolist():
                _, position, low, high = unpacked(place)
                rows += children(doc, place, data[position - high : position - low + LENGTH], CELLS[0])
            if len(rows) > 50_000:
                yield _child_frame(rows)
                rows = []
        yield _child_frame(rows)


class _Pass:
    """One pass over rows sorted by digit, content and order of the text: yields decided rows, and open ones of groups with several contents."""

    def __init__(self, columns: list[str]):
        self.columns = columns
        self.key = self.whole = None
        self.head: tuple[int, int] | None = None
        self.contents, self.waiting = 0, None

    def batch(self, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        key, whole, doc, place = (rows[c].to_numpy() for c in ("key", "whole", "doc", "place"))
        n = len(rows)
        new_key = np.append(self.key is None or key[0] != self.key, key[1:] != key[:-1])
        new = new_key | np.append(self.whole is None or whole[0] != self.whole, whole[1:] != whole[:-1])
        # The first row of each content, for rows before the first new one that of the batch before.
        at = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        head_doc = np.where(at >= 0, doc[at], self.head[0] if self.head else 0)
        head_place = np.where(at >= 0, place[at], self.head[1] if self.head else 0)
        decided = rows[~new & ((doc != head_doc) | (place != head_place))]

        group = np.cumsum(new_key) - new_key[0]  # 0: the first group of the batch
        contents = np.bincount(group[new], minlength=int(group[-1]) + 1)
        goes_on = not new_key[0]
        if goes_on:
            contents[0] += self.contents
        several = contents > 1
        open_ = rows[new & several[group]]
        if goes_on and several[0] and self.waiting is not None:
            open_ = pd.concat([self.waiting, open_])
            self.waiting = None
        last_group = int(group[-1])
        if last_group or not goes_on:
            self.waiting = None
        if contents[last_group] == 1 and (last_group or not goes_on):
            self.waiting = rows[new & (group == last_group)]
        self.key, self.whole, self.contents = key[-1], whole[-1], int(contents[last_group])
        self.head = (int(head_doc[-1]), int(head_place[-1]))
        return decided, open_


def _next_digit(cell: int | None, columns: list[str]):
    """A pass; open rows go on as children in cells of `cell` places, or as they are if None."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Pass(columns)
        for batch in batches:
            through = batch[batch["kind"] == DECIDED]
            if len(through):
                yield through[columns]
            rows = batch[batch["kind"] == OPEN]
            if not len(rows):
                continue
            decided, open_ = state.batch(rows)
            decided = decided.assign(kind=np.int32(DECIDED), key=mix64(decided["doc"].to_numpy().astype(np.uint64)).view(np.int64))
            if "context" in columns:
                decided = decided.assign(context=None)
            yield decided[columns]
            if cell is not None and len(open_):
                found = [c for d, p, x in zip(open_["doc"].tolist(), open_["place"].tolist(), open_["context"]) for c in children(d, p, x, cell)]
                yield _child_frame(found)[columns]
            elif cell is None:
                yield open_[columns]

    return run


def _sorted_pass(rows: DataFrame, cell: int | None) -> DataFrame:
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.repartition("key").sortWithinPartitions("kind", "key", "whole", "doc", "place")
    return dealt.mapInPandas(_next_digit(cell, rows.columns), schema)


def _pack(texts: pd.Series) -> pd.Series:
    """Compressed UTF-8: what a shuffle of whole texts moves."""
    return pd.Series([zlib.compress(t.encode(), 1) for t in texts], dtype=object)


def repeated_places(texts: DataFrame) -> DataFrame:
    """(doc, place) of all runs and parts of runs whose windows start earlier too; `texts` has doc, mark and text."""
    first = _sorted_pass(texts.mapInPandas(_first_digit, ROW), None)
    first = written(first, "first-digit")
    open_ = first.where(F.col("kind") == OPEN).select("doc", "place", F.shiftright("place", 45).alias("mark")).groupBy("doc", "mark").agg(F.collect_list("place").alias("places"))
    rows = open_.join(texts.select("doc", "mark", F.pandas_udf(_pack, "binary")("text").alias("packed")), ["doc", "mark"]).mapInPandas(_contexts, f"{ROW}, context binary")
    for cell in (*CELLS[1:], None):
        rows = _sorted_pass(rows, cell)
    decided = first.where(F.col("kind") == DECIDED).select("doc", "place")
    return decided.union(rows.where(F.col("kind") == DECIDED).select("doc", "place"))


def spans_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges that windows of the places cover, joined where they overlap or touch: starts and ends."""
    _, position, low, high = unpacked(places)
    begin, end = position - high, position - low + LENGTH
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > end[:-1])[: len(begin)]
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)] if len(end) else end


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` (doc_id, text) with `doc`, a number in the order of doc_id that tells texts of one doc_id apart.

    Texts without an id get numbers below the smallest id by a hash of 63 bits. Where some doc_id has several texts, `doc` is
    the distance from the smallest id followed by a hash of the text in all bits that the distance leaves of 63 (with the mark's 18, over 40
    bits for ids that lie within 2**40 of each other); where none has, it is the id.
    """
    digest = F.xxhash64("text", F.lit(2))
    ids = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high"))
    least, most, shared = ids.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.col("low") != F.col("high"))).first()
    without, floor = F.xxhash64("text", F.lit(1)), -(1 << 63)
    if shared and most - least < 1 << 63:
        free = 63 - (most - least).bit_length()
        distance = F.shiftleft(F.col("doc_id") - F.lit(least).cast("long"), free)
        return rows.withColumn("doc", F.coalesce(distance.bitwiseOR(digest.bitwiseAND(F.lit((1 << free) - 1).cast("long"))), without.bitwiseOR(F.lit(floor).cast("long"))))
    room = (0 if least is None else least) - floor  # numbers below the smallest id
    below = F.pmod(without, F.lit(min(max(room, 1), (1 << 63) - 1)).cast("long")) + F.lit(floor).cast("long")
    return rows.withColumn("doc", F.coalesce("doc_id", below))


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_removed, starts, ends (byte ranges removed), kept (binary) and kept_sha256 of each row of docs.

    Removed is each byte of the UTF-8 text that a LENGTH-byte string covers which also
    starts earlier: in a smaller doc_id, or earlier in the same text. Strings are judged on
    the input and never cross texts. A null text counts as empty. A null doc_id comes before
    all others. Different texts without an id, or with the same one, are told apart and put in a
    fixed order by a hash of the text (`numbered` says by how many bits); rows that repeat doc_id and text are one text
    and get equal results. An empty table gives an empty result; other columns are not read.
    """
    rows = numbered(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")))
    rows = rows.withColumn("mark", mark_of(F.col("text")))
    places = repeated_places(rows.select("doc", "mark", "text"))
    spans = places.select("doc", "place", F.shiftright("place", 45).alias("mark")).groupBy("doc", "mark").agg(F.collect_list("place").alias("places"))
    whole = rows.select("doc_id", "doc", "mark", F.pandas_udf(_pack, "binary")("text").alias("packed"))
    return whole.join(spans, ["doc", "mark"], "left").select("doc_id", "packed", "places").mapInPandas(_kept, KEPT)


KEPT = "doc_id long, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary, kept_sha256 string"


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, places in zip(batch["packed"], batch["places"]):
            data = zlib.decompress(text)
            start, end = spans_of(np.asarray(places if places is not None else [], np.int64))
            left = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(data)]))
            rows.append((len(data), len(data) - len(left), start, end, left, hashlib.sha256(left).hexdigest()))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "starts", "ends", "kept", "kept_sha256"])
        out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None) if len(batch) else [])
        yield out
