"""N-gram Jaccard join with token-combination prefixes.

Tokens are word shingles. They have a global order, rare ones first, by the corpus count of
a shingle's rarest word; counts of words are kept in a table of fixed size. A set's prefix is the smallest head of the order that must share a
signature with every set similar enough: a rare token is a signature by itself; frequent
tokens are dealt into small groups and their combinations of two or three within a group
are signatures, for which the prefix is longer. Sets with a common signature are verified.

Equal sets are joined as one. Of the sets with a signature, all are compared with the first
one: each set with the smallest such first one at once, then with others from which it is
still separate. What is in different components after that is compared pair by pair: where a
signature has many such pairs, those of a spanning forest by the bitmaps' nearness come first,
and the others only if they are in different components after that.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import bit_set, discard, filter_bits, in_small_batches, join_counted, text_or_empty, written
from acoustic_spark.llm.components import components

#: Words of a shingle and wanted similarity where a caller names no others.
WORDS_IN_SHINGLE, PERCENT = 4, 85
#: Buckets of the table of word counts, one byte each; words that share one count as one.
BUCKETS, RANGE = 1 << 24, 1 << 18
#: A word's level grows by one with each doubling of its count. From these levels on signatures
#: are combinations of two and of three; a word of up to 63 occurrences is rare.
PAIRS, TRIPLES = 6, 14
#: Tokens of a group on average, for combinations of two and of three.
GROUP = {2: 4, 3: 5}
#: Sets of fewer shingles have single tokens as signatures whatever their level.
SMALL = 8
#: Different words that a task counts before it passes them on, and whose hashes it keeps at hand.
HELD, KNOWN = 1 << 19, 1 << 17
LEVEL_BITS = 5
#: A set's tokens as a bitmap of so many 64-bit words. Each bit that one set has alone is a token that the other lacks.
BITMAP_WORDS = 16
#: Sets of one signature that are compared with each other in one step.
BLOCK = 4096
#: Pairs per row that such a step gives of one signature, round by round; of more it gives a spanning forest. The last round gives all.
FEW = (4, 32, 256, None)
#: A pair of sets that share several open signatures is looked at in the smallest one, if both have that among so many smallest.
SMALLEST = 16
#: Pairs whose bitmaps are compared at once.
STEP = 1 << 18

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


class WordHashes(dict):
    """Word to its 64-bit hash with its level in the lowest bits; forgets everything when it has grown large."""

    def __init__(self, levels: bytes):
        super().__init__()
        self.levels = levels

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        level = self.levels[h % BUCKETS] if self.levels else 0
        self[word] = h = h >> LEVEL_BITS << LEVEL_BITS | level
        return h


def shingles(words: list[bytes], hashes: WordHashes, n: int = WORDS_IN_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The set's shingles as sorted 64-bit hashes, and the level of each, that of its rarest word."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    levels = (h & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.uint8)
    width = min(n, len(words))
    size = len(words) - width + 1
    total = np.zeros(size, np.uint64)
    level = levels[:size].copy()
    for i in range(width):
        part = h[i : i + size]
        total += (part ^ (part >> np.uint64(29))) * np.uint64(FACTORS[i % len(FACTORS)] + 2 * (i // len(FACTORS)))
        np.minimum(level, levels[i : i + size], out=level)
    found, first = np.unique(mix64(total + np.uint64(width)), return_index=True)
    return found, level[first]


def errors(size: int, percent: int = PERCENT) -> int:
    """How many tokens of a set a similar set may lack at most."""
    return size + (-percent * size // 100)


def bands(size: int, percent: int = PERCENT) -> set[int]:
    """Size bands of a set: two sets that are similar enough have one in common."""
    return {size.bit_length(), (-(-100 * size // percent)).bit_length()}


def signatures(tokens: np.ndarray, levels: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Signatures of a set. Two sets of at least the wanted similarity have one in common.

    With p errors allowed, single tokens count one each and a group of g tokens with
    combinations of k counts g - k + 1, as so many errors at most are needed to break all of
    its signatures; the prefix is long enough when the sum is over p. The order of tokens,
    their classes and groups depend on the token alone (groups on the size band too), so the
    set whose prefix ends first in the order finds its unbroken signature in the other's prefix.
    """
    size = len(tokens)
    if not size:
        return np.empty(0, np.uint64)
    need = errors(size, percent) + 1
    order = np.lexsort((tokens, levels))
    tokens, levels = tokens[order], levels[order]
    rare = int(np.searchsorted(levels, PAIRS))
    if rare >= need:
        return tokens[:need]
    out = [tokens[:rare]]
    for band in bands(size, percent):
        if band < SMALL.bit_length():
            out.append(mix64(tokens[rare : rare + need] + np.uint64(band)))
            continue
        lowest = 1 << (band - 1)
        groups = {k: max(1, (errors(lowest, percent) + 1) // (g - k + 1)) for k, g in GROUP.items()}
        held: dict[tuple[int, int], list[int]] = {}
        left = need - rare
        for token, level in zip(tokens[rare:].tolist(), levels[rare:].tolist()):
            k = 3 if level >= TRIPLES else 2
            members = held.setdefault((k, (token >> 20) % groups[k]), [])
            members.append(token)
            left -= len(members) >= k
            if not left:
                break
        found = [
            (sum(t * FACTORS[i] for i, t in enumerate(sorted(chosen))) + band * FACTORS[3] + k) & 0xFFFFFFFFFFFFFFFF
            for (k, _), members in held.items() for chosen in combinations(members, k)
        ]
        out.append(mix64(np.array(found, np.uint64)))
    return np.unique(np.concatenate(out))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
    bits[tokens % np.uint64(len(bits))] = 1
    return np.packbits(bits).view(np.uint64)


def bitmaps(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, BITMAP_WORDS)


def lacks(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bits each of two bitmaps (last axis) has alone."""
    lack_x = lack_y = 0
    for i in range(BITMAP_WORDS):
        a, b = x[..., i], y[..., i]
        common = a & b
        lack_x = lack_x + np.bitwise_count(a ^ common).astype(np.int32)
        lack_y = lack_y + np.bitwise_count(b ^ common).astype(np.int32)
    return lack_x, lack_y


def room(lack_x: np.ndarray, n_x: np.ndarray, lack_y: np.ndarray, n_y: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    both = -(-percent * (n_x + n_y) // (100 + percent))  # tokens that similar sets have in common at least
    return (lack_x <= n_x - both) & (lack_y <= n_y - both)


def may_be_similar(x: np.ndarray, n_x: np.ndarray, y: np.ndarray, n_y: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether bitmaps (last axis) and sizes of sets leave room for the wanted similarity; true for all similar sets."""
    lack_x, lack_y = lacks(x, y)
    return room(lack_x, n_x, lack_y, n_y, percent)


def forest(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Which of the edges between labels a and b make a spanning forest of the smallest distances: less than one a label."""
    order = np.argsort(distance, kind="stable")
    labels, ends = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    edge, low, high = np.arange(len(order)), ends[: len(order)], ends[len(order) :]
    chosen: list[int] = []
    while True:
        apart = low != high
        edge, low, high = edge[apart], low[apart], high[apart]
        if not len(edge):
            return order[chosen]
        # Every label's first edge, and what these join becomes one label.
        first = np.full(len(labels), len(edge))
        np.minimum.at(first, low, np.arange(len(edge)))
        np.minimum.at(first, high, np.arange(len(edge)))
        parent = list(range(len(labels)))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        for at in np.unique(first[first < len(edge)]).tolist():
            x, y = root(low[at]), root(high[at])
            if x != y:
                parent[x] = y
                chosen.append(int(edge[at]))
        joined = np.array([root(i) for i in range(len(labels))])
        low, high = joined[low], joined[high]


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences by bucket of the word's hash, passed on whenever HELD different words have come together."""

    def frame(held: Counter) -> pd.DataFrame:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held))
        bucket, at = np.unique(hashes % np.uint64(BUCKETS), return_inverse=True)
        return pd.DataFrame({"bucket": bucket.astype(np.int32), "n": np.bincount(at, list(held.values()), len(bucket)).astype(np.int64)})

    held: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            held.update(words_of(text))
            if len(held) >= HELD:
                yield frame(held)
                held = Counter()
    yield frame(held)


def _level_range(rows: pd.DataFrame) -> pd.DataFrame:
    out = np.zeros(RANGE, np.uint8)
    out[rows["bucket"] % RANGE] = np.minimum(np.log2(rows["n"]).astype(int), (1 << LEVEL_BITS) - 1)
    return pd.DataFrame({"range": [int(rows["bucket"].iloc[0]) // RANGE], "levels": [zlib.compress(out.tobytes(), 1)]})


def word_levels(texts: DataFrame) -> bytes:
    """Level of each bucket from the counts of all words of all texts; always BUCKETS bytes, joined on the driver from BUCKETS / RANGE compressed rows."""
    counts = texts.select("text").mapInPandas(_count_words, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    rows = counts.groupBy((F.col("bucket") / RANGE).cast("int")).applyInPandas(_level_range, "range int, levels binary").collect()
    out = bytearray(BUCKETS)
    for row in rows:
        out[row["range"] * RANGE : (row["range"] + 1) * RANGE] = zlib.decompress(row["levels"])
    return bytes(out)


SETS = "number long, doc_id long, n_shingles long, digest binary, signatures array<long>, bits binary"


def _prepared(levels, n: int, percent: int) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes(levels.value)
        for batch in batches:
            rows = []
            ids = batch["doc_id"].astype("Int64")
            for number, doc_id, text in zip(batch["number"], ids, batch["text"]):
                if len(hashes) > KNOWN:
                    hashes.clear()
                tokens, level = shingles(words_of(text), hashes, n)
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None
                rows.append((number, None if doc_id is pd.NA else doc_id, len(tokens), digest, signatures(tokens, level, percent).view(np.int64), bitmap(tokens).tobytes()))
            yield pd.DataFrame(rows, columns=["number", "doc_id", "n_shingles", "digest", "signatures", "bits"]).astype({"doc_id": "Int64"})

    return run


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From rows sorted by signature and number: pairs of a signature's first set with each other, and the rows of signatures with three sets or more.

    Rows come in batches; of the signature that a batch ends with only its first set, and a second row that may turn out to be one of three, are kept.
    """
    columns = ["signature", "a", "b"]
    last = first = second = None  # of the signature that is open: its first two sets
    n_open = 0
    for batch in batches:
        signature, number = batch["signature"].to_numpy(), batch["number"].to_numpy()
        if not len(signature):
            continue
        start = np.flatnonzero(np.append(True, signature[1:] != signature[:-1]))
        size = np.diff(np.append(start, len(signature)))
        head = np.repeat(number[start], size)
        place = np.arange(len(signature)) - np.repeat(start, size)
        total = np.repeat(size, size)
        goes_on = last is not None and signature[0] == last
        if goes_on:
            place[: size[0]] += n_open
            head[: size[0]] = first
            total[: size[0]] += n_open
        pair = place > 0
        many = total >= 3
        rows = [pd.DataFrame({"signature": 0, "a": head[pair], "b": number[pair]}).drop_duplicates(), pd.DataFrame({"signature": signature[many], "a": number[many], "b": -1})]
        if goes_on and n_open < 3 <= n_open + size[0]:
            early = [first] if n_open == 1 else [first, second]
            rows.append(pd.DataFrame({"signature": last, "a": early, "b": -1}))
        yield pd.concat(rows)[columns]
        if goes_on and len(size) == 1:
            second = number[0] if n_open == 1 else second
            n_open += int(size[0])
        else:
            last, n_open, begin = signature[-1], int(size[-1]), start[-1]
            first, second = number[begin], number[begin + 1] if n_open > 1 else None


def _verified(n: int, percent: int) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes(b"")
        cached: dict[int, np.ndarray] = {}

        def tokens(number: int, packed: bytes) -> np.ndarray:
            if number not in cached:
                if len(cached) > 200:
                    cached.clear()
                cached[number] = shingles(words_of(zlib.decompress(packed).decode()), hashes, n)[0]
            return cached[number]

        for batch in batches:
            if len(hashes) > KNOWN:
                hashes.clear()
            keep = [similar(tokens(a, x), tokens(b, y), percent) for a, b, x, y in zip(batch["a"], batch["b"], batch["packed_a"], batch["packed_b"])]
            yield batch.loc[keep, ["a", "b"]]

    return run


def _near(percent: int) -> object:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = may_be_similar(bitmaps(batch["bits_a"]), batch["n_a"].to_numpy(), bitmaps(batch["bits_b"]), batch["n_b"].to_numpy(), percent)
            yield batch.loc[keep, ["a", "b"]]

    return run


def near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set numbers for which sizes and bitmaps leave room; `sets` has number, n_shingles and bits."""
    small_a = sets.select(F.col("number").alias("a"), F.col("n_shingles").alias("n_a"), F.col("bits").alias("bits_a"))
    small_b = sets.select(F.col("number").alias("b"), F.col("n_shingles").alias("n_b"), F.col("bits").alias("bits_b"))
    return pairs.join(small_a, "a").join(small_b, "b").mapInPandas(_near(percent), "a long, b long")


def maybe_among(rows: DataFrame, members: DataFrame, n_members: int) -> DataFrame:
    """The rows whose number is in `members`, and few others, without moving any row.

    The bitmap of hashed numbers is broadcast, 16 bits a member and 128 MB at most (`filter_bits`). Where members are more
    than that holds, more other rows come through, which costs their way to a join but no result.
    """
    bits = filter_bits(n_members)
    slot = F.pmod(F.xxhash64("number"), F.lit(bits)) + 1  # bitmap functions number from 1
    bucket, position = F.bitmap_bucket_number("slot"), F.bitmap_bit_position("slot")
    bitmaps = members.select(slot.alias("slot")).groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bitmap"))
    found = rows.withColumn("slot", slot).join(F.broadcast(bitmaps), bucket == F.col("bucket"))
    return found.where(bit_set(F.col("bitmap"), position)).select(rows.columns)


def verify(pairs: DataFrame, rows: DataFrame, n: int, percent: int) -> DataFrame:
    """A written table of the pairs (a, b) that are similar enough; `rows` has number and text.

    Only texts of these pairs are moved, compressed: a bitmap of their numbers keeps nearly all others from the join.
    """
    involved = pairs.select(F.col("a").alias("number")).union(pairs.select("b")).distinct()
    likely = maybe_among(rows.select("number", "text"), involved, 2 * pairs.count())
    packed = likely.select("number", F.col("text").cast("binary").alias("packed")).mapInPandas(_compressed, "number long, packed binary")
    texts = written(packed.join(involved, "number", "left_semi"), "texts")
    left = texts.select(F.col("number").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("number").alias("b"), F.col("packed").alias("packed_b"))
    links = written(pairs.join(left, "a").join(right, "b").mapInPandas(_verified(n, percent), "a long, b long"), "links")
    discard(texts)
    return links


def _compressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(packed=[zlib.compress(text, 1) for text in batch["packed"]])


class _Rows:
    """Columns of a batch as arrays."""

    def __init__(self, rows: pd.DataFrame):
        self.keys = rows[["signature", "low", "high"]].to_numpy()
        self.number, self.component, self.size = (rows[c].to_numpy() for c in ("number", "component", "n_shingles"))
        self.block, self.bits = rows["block"].to_numpy(), bitmaps(rows["bits"])
        self.smallest = np.concatenate(rows["smallest"].to_list()).reshape(-1, SMALLEST)

    def elsewhere(self, p: np.ndarray, q: np.ndarray, signature: int) -> np.ndarray:
        """Whether the pair is looked at in a smaller signature: both sets have it, and as one of their smallest."""
        x, y = self.smallest[p], self.smallest[q]
        found = np.zeros(len(p), bool)
        for i in range(SMALLEST):
            found |= (x[:, i] < signature) & (x[:, i, None] == y).any(axis=1)
        return found

    def pairs(self, begin: int, end: int, percent: int, few: int | None) -> tuple[np.ndarray, bool]:
        """Pairs (smaller, larger number) of one signature's block pair that sizes and bitmaps leave, in different components.

        If they are more than `few` a row, only those of a spanning forest of the components, nearest bitmaps first, and true.
        """
        signature, low, high = self.keys[begin].tolist()
        left = begin + np.flatnonzero(self.block[begin:end] == low)
        right = left if low == high else begin + np.flatnonzero(self.block[begin:end] == high)
        held, n_held, more = [(np.empty(0, int), np.empty(0, int), np.empty(0))], 0, False
        step = max(1, STEP // max(1, len(right)))
        for first in range(0, len(left), step):
            i, j = left[first : first + step, None], right[None, :]
            apart = self.component[i] != self.component[j]
            if low == high:
                apart &= i < j
            p, q = np.nonzero(apart)
            if not len(p):
                continue
            p, q = i[p, 0], j[0, q]
            lack_p, lack_q = lacks(self.bits[p], self.bits[q])
            near = np.flatnonzero(room(lack_p, self.size[p], lack_q, self.size[q], percent))
            near = near[~self.elsewhere(p[near], q[near], signature)]
            p, q = p[near], q[near]
            held.append((p, q, (lack_p[near] + lack_q[near]) / (self.size[p] + self.size[q])))
            n_held += len(p)
            if few is not None and n_held > few * (end - begin):
                p, q, distance = map(np.concatenate, zip(*held))
                keep = forest(self.component[p], self.component[q], distance)
                held, n_held, more = [(p[keep], q[keep], distance[keep])], len(keep), True
        p, q, distance = map(np.concatenate, zip(*held))
        if more:
            keep = forest(self.component[p], self.component[q], distance)
            p, q = p[keep], q[keep]
        return np.sort(np.stack([self.number[p], self.number[q]], axis=1), axis=1), more


FOUND = "a long, b long, signature long"


def _blocks(percent: int, few: int | None) -> object:
    """Pairs from rows sorted by (signature, low, high), each once a batch, and rows of the signatures that have more.

    One block pair is held at a time.
    """

    def frame(rows: _Rows, cuts: list[int]) -> pd.DataFrame:
        found, cut_short = [np.empty((0, 2), np.int64)], []
        for begin, end in zip(cuts, cuts[1:]):
            pairs, more = rows.pairs(begin, end, percent, few)
            found.append(pairs)
            cut_short += [int(rows.keys[begin, 0])] * more
        pairs = pd.DataFrame(np.concatenate(found), columns=["a", "b"]).drop_duplicates().assign(signature=None)
        rest = pd.DataFrame({"a": None, "b": None, "signature": cut_short})
        return pd.concat([x.astype("Int64") for x in (pairs, rest)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            rows = _Rows(batch)
            cuts = np.flatnonzero(np.append(True, (rows.keys[1:] != rows.keys[:-1]).any(axis=1))).tolist()
            yield frame(rows, cuts)
            rest = batch.iloc[cuts[-1] :]
        if rest is not None:
            yield frame(_Rows(rest), [0, len(rest)])

    return run


def block_pairs(open_: DataFrame, sets: DataFrame, percent: int, few: int | None = None) -> DataFrame:
    """Pairs (a, b) of sets with a common signature and different components that may be similar, each once.

    `open_` has signature, number and component. A large signature is cut into blocks by
    number, and every two blocks meet in a group of their own. A group with more than `few`
    pairs a row gives those of a spanning forest only; its signature comes in a row without a pair.
    """
    listed = F.sort_array(F.collect_list("signature"))
    padded = F.concat(listed, F.array_repeat(F.lit((1 << 63) - 1), SMALLEST))
    smallest = open_.groupBy("number").agg(F.slice(padded, 1, SMALLEST).alias("smallest"))
    rows = open_.join(sets.select("number", "n_shingles", "bits").join(smallest, "number"), "number")
    blocks = open_.groupBy("signature").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(blocks, "signature").withColumn("block", F.pmod(F.hash("number"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other")
    dealt = rows.repartition("signature", "low", "high").sortWithinPartitions("signature", "low", "high")
    return dealt.mapInPandas(_blocks(percent, few), FOUND).distinct()


@in_small_batches
def join_similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = WORDS_IN_SHINGLE, percent: int = PERCENT, number: str | None = None) -> DataFrame:
    """number, doc_id, n_shingles, component_id, n_links and kept for each row of docs.

    A document's set is its distinct n-word shingles (all its words as one if they are
    fewer); documents link when 100 * intersection >= percent * union. component_id is the
    smallest doc_id reachable by links, n_links the links found of its set (a spanning part
    of them, copies not counted). A null text or one without words has an empty set, links
    with nothing and is its own component. Rows that repeat a doc_id count each; a null
    doc_id comes after all others. `number` names a column of row numbers that stay the same
    when docs is read again; without it rows get numbers of their own. kept is true for one
    row of each component, that of the smallest doc_id and then number. An empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"), (F.monotonically_increasing_id() if number is None else F.col(number)).alias("number"))
    rows = written(rows, "rows") if number is None else rows
    levels = docs.sparkSession.sparkContext.broadcast(word_levels(rows))
    prepared = written(rows.mapInPandas(_prepared(levels, n, percent), SETS), "sets")
    levels.destroy()

    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("number").alias("row"))
    classes = prepared.where("digest is not null").groupBy("digest").agg(F.min("number").alias("number"), F.min(order).alias("smallest"), F.count(F.lit(1)).alias("n_class"))
    classes = written(classes, "classes")
    # Of equal sets the first one stands for all; the list of the others is shorter than that of the first ones.
    repeated = classes.where("n_class > 1").select("digest", F.col("number").alias("stands"))
    copies = prepared.select("number", "digest").join(repeated, "digest").where("number <> stands").select("number")
    first = prepared.where("digest is not null").select("number", "signatures").join(copies, "number", "left_anti")
    postings = first.select("number", F.explode("signatures").alias("signature"))
    grouped = postings.repartition("signature").sortWithinPartitions("signature", "number")
    stars = written(grouped.mapInPandas(_stars, "signature long, a long, b long"), "stars")

    pairs = written(near(stars.where("b >= 0").select("a", "b").distinct(), prepared, percent), "pairs")
    shared = stars.where("b < 0").select("signature", F.col("a").alias("number"))
    nearest = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "nearest")
    links = verify(nearest, rows, n, percent)
    found = components(links)

    def separate(candidates: DataFrame) -> DataFrame:
        """Pairs of sets that are in different components so far."""
        of_a = found.select(F.col("node").alias("a"), F.col("component").alias("of_a"))
        of_b = found.select(F.col("node").alias("b"), F.col("component").alias("of_b"))
        known = candidates.join(of_a.hint("merge"), "a", "left").join(of_b.hint("merge"), "b", "left")
        return known.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")

    def extend(candidates: DataFrame) -> None:
        nonlocal links, found
        if not candidates.limit(1).count():
            return
        more = verify(candidates, rows, n, percent)
        if more.limit(1).count():
            links = links.union(more)
            discard(found)
            found = components(links)

    others = written(separate(pairs.join(nearest, ["a", "b"], "left_anti")), "others")
    extend(others)
    discard(pairs, nearest, others)

    # Signatures whose sets are in different components yet. Of those that have the same sets only one is looked at:
    # long texts that are almost similar share hundreds.
    def mixed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(signature, number) rows with the set's component so far, and the signatures of more than one."""
        labelled = rows.join(found.withColumnRenamed("node", "number"), "number", "left").withColumn("component", F.coalesce("component", "number"))
        members = [F.bit_xor(F.xxhash64(F.lit(seed), "number")).alias(f"members{seed}") for seed in (1, 2)]
        grouped = labelled.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"), *members)
        return labelled, grouped.where("low < high")

    labelled, several = mixed(shared)
    several = several.groupBy("n", "members1", "members2").agg(F.min("signature").alias("signature"))
    open_ = written(labelled.join(several.select("signature"), "signature").select("signature", "number", "component"), "open")
    discard(stars)
    tried = []
    for few in FEW:
        across = written(block_pairs(open_, prepared, percent, few), "across")
        candidates = across.where("signature IS NULL").select("a", "b")
        for before in tried:
            candidates = candidates.join(before.select("a", "b"), ["a", "b"], "left_anti")
        extend(candidates)
        tried.append(across)
        # Signatures that have more pairs than they gave: only these are looked at again.
        rest = across.where("signature IS NOT NULL").select("signature").distinct()
        if not rest.limit(1).count():
            break
        labelled, several = mixed(open_.select("signature", "number").join(rest, "signature"))
        reopened = written(labelled.join(several.select("signature"), "signature").select("signature", "number", "component"), "open")
        discard(open_)
        open_ = reopened
    discard(open_, *tried)

    degree = links.select(F.col("a").alias("number")).union(links.select("b")).groupBy("number").agg(F.count(F.lit(1)).alias("n_links"))
    each = classes.join(found.withColumnRenamed("node", "number"), "number", "left").withColumn("component", F.coalesce("component", "number"))
    each = each.join(degree, "number", "left").na.fill({"n_links": 0})
    ids = each.groupBy("component").agg(F.min("smallest").alias("best"))
    each = each.join(ids, "component").select("digest", F.col("best.id").alias("component_id"), F.col("best.row").alias("kept_row"), "n_class", "n_links")
    narrow = prepared.select("number", "doc_id", "n_shingles", "digest")
    linked = join_counted(narrow.where("digest is not null"), each, "digest", "n_class", prepared.count())
    alone = narrow.where("digest is null").withColumns({"component_id": F.col("doc_id"), "kept_row": F.col("number"), "n_class": F.lit(1).cast("long"), "n_links": F.lit(0).cast("long")})
    done = linked.unionByName(alone).select("number", "doc_id", "n_shingles", "component_id", "n_links", (F.col("number") == F.col("kept_row")).alias("kept"))
    done = written(done, "linked")
    discard(prepared, classes, *([rows] if number is None else []))
    return done
