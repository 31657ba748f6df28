"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pairs of parts that can merge wait in buckets, one per merge rank, which hold
positions of a linked list. Two levels of bitmaps say which buckets have entries: the
first bit set gives the next rank. Entries that a merge beside them made stale are skipped
when they come up. All pre-tokens that a worker has not seen yet lie one behind the other
in one linked list, so a bucket is merged in one vectorised step for all of them; a very
long pre-token is merged in the same way, at the same cost a merge.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from acoustic_spark.llm.common import fresh, text_or_empty

#: Different pre-tokens remembered by a worker; then it starts anew.
CACHE = 150_000
#: Characters of text that are encoded in one step, and of a text that is matched piece by piece.
STEP, LONG_TEXT = 2 << 20, 1 << 20
#: Unicode White_Space, in place of \s, which also has four control characters here.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the usual pattern, which `usual_pieces` cuts by character classes instead of matching it.
USUAL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE, LETTER, NUMBER, OTHER = range(4)


@cache
def character_classes() -> np.ndarray:
    """Class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for code, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, f"[{WHITE}]+")):
        for m in regex.finditer(pattern, points):
            # Surrogates are no characters, so a run of points may leap over them; they stay OTHER.
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = code
    out[0xD800:0xE000] = OTHER
    return out


def usual_pieces(text: str) -> list[str]:
    """The matches of the usual pattern: runs of one class, a space before a run with it, contractions by themselves."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = character_classes()[points]
    cut = np.empty(n + 1, bool)
    cut[0] = cut[n] = True
    np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
    begins = np.flatnonzero(cut[1:n] & (kind[:-1] == SPACE)) + 1  # a run after white space
    cut[begins - 1] = True
    cut[begins[points[begins - 1] == 0x20]] = False
    if "'" in text:
        for i in np.flatnonzero((points == 0x27) & cut[:n]).tolist():
            length = 2 if text[i + 1 : i + 2] in ("s", "t", "m", "d") else 3 if text[i + 1 : i + 3] in ("re", "ve", "ll") else 0
            if length:
                cut[i + 1] = False
                cut[i + length] = True
    at = np.flatnonzero(cut).tolist()
    return [text[i:j] for i, j in zip(at, at[1:])]


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def compiled(pattern: str) -> regex.Pattern:
    r"""The pattern with \s and \S as Unicode white space."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        two = pattern[at : at + 2]
        if two == r"\s":
            out.append(WHITE if inside else f"[{WHITE}]")
            at += 2
        elif two == r"\S" and not inside:
            out.append(f"[^{WHITE}]")
            at += 2
        elif pattern[at] == "\\":
            out.append(two)
            at += 2
        else:
            inside = pattern[at] == "[" or inside and pattern[at] != "]"
            out.append(pattern[at])
            at += 1
    return regex.compile("".join(out))


class _Pieces(dict):
    """Pre-token to its number, numbered as they come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern, self.usual = compiled(pattern), pattern == USUAL
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.top = max(ranks.values(), default=0) + 2
        # Every way to make a token of two tokens, as sorted numbers left * top + right.
        made = [(ranks[t[:i]] * self.top + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        made.sort()
        self.pair_keys = np.array([k for k, _ in made], np.int64)
        self.pair_ranks = np.array([r for _, r in made], np.int32)
        # Tokens that are part of an earlier-ranked token: merging one can bring up a lower rank, so their merges are looked at one by one.
        parts = self.pair_keys[:, None] // np.array([self.top, 1]) % self.top
        self.early = np.zeros(self.top, bool)
        self.early[parts[self.pair_ranks[:, None] < parts]] = True
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self._forget()

    def _forget(self) -> None:
        self.seen, self.flat = _Pieces(), np.empty(0, np.int32)
        self.start, self.length = np.empty(0, np.int64), np.empty(0, np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, -1 if none."""
        if not len(self.pair_keys):
            return np.full(len(left), -1, np.int32)
        key = left.astype(np.int64) * self.top + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens one behind the other, and how many each has.

        In each pre-token the lowest-ranked pair merges first, the leftmost of equal ranks.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(text)
        token = np.append(self.byte_id[text], np.int32(-1))
        if (token[:n] < 0).any():
            raise KeyError("the vocabulary lacks a byte")
        ends = np.cumsum(lengths)
        first = (ends - lengths)[lengths > 0]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends[lengths > 0] - 1] = n  # position n stands for "none"
        before[first] = n
        rank_at = np.full(n + 1, -1, np.int32)
        alive = np.ones(n, bool)
        piece_of = np.repeat(np.arange(len(pieces)), lengths)
        buckets: dict[int, list[np.ndarray]] = {}
        low, high = [0] * ((self.top >> 8) + 1), 0

        def push(at: np.ndarray) -> int:
            """Ranks the pairs that start at these positions anew and puts them into their buckets; bits for the upper level."""
            right = after[at]
            ranks = np.where(right < n, self._rank(token[at], token[right]), -1)
            rank_at[at] = ranks
            at, ranks = at[ranks >= 0], ranks[ranks >= 0]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            bits = 0
            for r, begin, end in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
                if r in buckets:
                    buckets[r].append(at[begin:end])
                else:
                    buckets[r] = [at[begin:end]]
                    low[r >> 8] |= 1 << (r & 255)
                    bits |= 1 << (r >> 8)
            return bits

        high |= push(np.arange(n))
        while high:
            h = (high & -high).bit_length() - 1
            word = low[h]
            r = h << 8 | (word & -word).bit_length() - 1
            entries = buckets.pop(r)
            low[h] = word = word & (word - 1)
            if not word:
                high &= high - 1
            at = entries[0] if len(entries) == 1 else np.unique(np.concatenate(entries))
            at = at[rank_at[at] == r]  # others are stale
            if not len(at):
                continue
            if len(at) > 1 and (touch := at[1:] == after[at[:-1]]).any():
                # Pairs that overlap, as in aaa: from the left, every other one of a run merges.
                run_start = np.flatnonzero(np.append(True, ~touch))
                place = np.arange(len(at)) - np.repeat(run_start, np.diff(np.append(run_start, len(at))))
                at = at[place % 2 == 0]
            if self.early[r] and len(at) > 1:
                # One by one from the left, would a merge bring up a lower rank? Those behind it in its pre-token wait.
                same = np.append(False, before[at[1:]] == at[:-1])
                left, right = token[before[at]], token[after[after[at]]]
                left[same] = r
                mine = np.full(len(at), r)
                found = np.stack([np.where(left >= 0, self._rank(left, mine), -1), np.where(right >= 0, self._rank(mine, right), -1)])
                lower = ((found >= 0) & (found < r)).any(axis=0)
                if lower.any():
                    so_far = np.cumsum(lower) - lower
                    piece = piece_of[at]
                    piece_start = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
                    wait = so_far > np.repeat(so_far[piece_start], np.diff(np.append(piece_start, len(at))))
                    if wait.any():
                        buckets[r] = [at[wait]]
                        low[h] |= 1 << (r & 255)
                        high |= 1 << h
                        at = at[~wait]
            gone = after[at]
            nxt = after[gone]
            token[at] = r
            after[at] = nxt
            before[nxt[nxt < n]] = at[nxt < n]
            rank_at[gone] = -1
            alive[gone] = False
            left = before[at]
            high |= push(np.unique(np.concatenate([left[left < n], at])))
        return token[:n][alive], np.bincount(piece_of[alive], minlength=len(pieces))

    def _learn(self, known: int) -> None:
        """Encodes the pre-tokens numbered from `known` on."""
        new = [p.encode() for p in list(self.seen)[known:]]
        whole = np.array([self.ranks.get(p, -1) for p in new], np.int32)
        flat, length = self.merge([p if w < 0 else b"" for p, w in zip(new, whole.tolist())])
        # A pre-token that is a token stands for itself.
        at = np.cumsum(length) - length
        self.flat = np.concatenate([self.flat, np.insert(flat, at[whole >= 0], whole[whole >= 0])])
        self.length = np.concatenate([self.length, np.where(whole >= 0, 1, length)])
        self.start = np.cumsum(self.length) - self.length

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text; pre-tokens are gathered over STEP characters."""
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= STEP):
                size += len(texts[end])
                end += 1
            if len(self.seen) > CACHE:
                self._forget()
            known, number = len(self.seen), self.seen.__getitem__
            numbers = []
            for t in texts[begin:end]:
                if len(t) <= LONG_TEXT:
                    pieces = usual_pieces(t) if self.usual else self.pattern.findall(t)
                    numbers.append(np.array(list(map(number, pieces)), np.int64))
                else:
                    numbers.append(np.fromiter((number(m[0]) for m in self.pattern.finditer(t)), np.int64))
            if len(self.seen) > known:
                self._learn(known)
            for each in numbers:
                length = self.length[each]
                shift = self.start[each] - (np.cumsum(length) - length)
                yield self.flat[np.repeat(shift, length) + np.arange(length.sum())]
            begin = end

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_loaded: dict[tuple[int, int], Bpe] = {}


def _shared(data: bytes, pattern: str) -> Bpe:
    """The vocabulary's encoder in this Python worker, built once while the worker lives; only the last one is kept."""
    key = (hash(data), hash(pattern))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(parse_ranks(data), pattern)
    return _loaded[key]


def steps(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts cut into parts of about STEP bytes, a longer text by itself."""
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    part = (np.cumsum(size) - size) // STEP
    cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(texts)]
    for begin, end in zip(cuts, cuts[1:]):
        yield texts.slice(begin, end - begin)


def coder(df: DataFrame, ranks_path: str, pattern: str) -> tuple[Callable, Callable]:
    """Column functions (encode, decode): text to a struct of ids (array<int>) and decoded (binary, the bytes of these ids), array<int> to binary.

    The driver reads the vocabulary file (a few MB) and sends it to the workers. A null text
    counts as empty and gives no ids; null ids give null; ids that the vocabulary lacks are an error.
    Both results of `encode` come from one function, so that a task has one Python worker; it passes
    them on in steps of STEP characters.
    """
    data = df.sparkSession.sparkContext.broadcast((Path(ranks_path).read_bytes(), pattern))

    @F.arrow_udf("ids array<int>, decoded binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _shared(*data.value)
        for texts in batches:
            for part in steps(texts):
                ids = list(bpe.encode([t or "" for t in part.to_pylist()]))
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *ids]))
                decoded = pa.array([bpe.decode(i.tolist()) for i in ids], pa.binary())
                yield pa.StructArray.from_arrays([lists, decoded], ["ids", "decoded"])

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _shared(*data.value)
        for ids in batches:
            yield pd.Series([None if i is None else bpe.decode(i.tolist()) for i in ids], dtype=object)

    return encode, decode


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """`docs` with ids (array<int>) and decoded (binary, the bytes that the ids stand for).

    Each match of `pattern` is encoded by itself, without special tokens. A null or empty
    text gives no ids; texts of any length are encoded whole. Rows stay one to one, repeated
    ones too; an empty table gives an empty result. Columns named ids and decoded are replaced.
    """
    encode, _ = coder(docs, ranks_path, pattern)
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    coded = fresh(docs, "coded")[0]
    rows = docs.withColumn(coded, encode(text_or_empty(text)))
    return rows.select(*keep, F.col(f"{coded}.ids").alias("ids"), F.col(f"{coded}.decoded").alias("decoded"))
