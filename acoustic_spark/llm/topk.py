"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; mean and deviation of a segment bound what it adds to an
inner product: at most m * (mean_q * mean_x + dev_q * dev_x) for m components (for vectors
of given length this is a lower bound of their distance). Coarse segments are tried first,
finer ones for what they leave, and exact products are computed for the survivors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

#: Segments at each resolution, coarse to fine.
RESOLUTIONS = (1, 4, 16)
#: Queries that are sent to all tasks at once; more go in further blocks, so memory is bounded.
QUERY_BLOCK = 16384
#: Candidates and queries compared in one step.
ROWS, QUERIES = 4096, 512
#: Products of components below this are exact in float64 sums of up to 2**13 components.
EXACT_FLOAT = 1 << 20


def scaled(embedding: str = "embedding", scale: int = 256) -> F.Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def valid(embedding: str = "embedding") -> F.Column:
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(embedding).isNotNull() & (F.size(embedding) > 0) & fine


def segment_statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(m) times mean and deviation of each segment, so that plain products of them give the bound."""
    cuts = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int)
    m = np.diff(cuts)
    sums = np.add.reduceat(v, cuts[:-1], axis=1)
    squares = np.add.reduceat(v * v, cuts[:-1], axis=1)
    mean = sums / m
    return mean * np.sqrt(m), np.sqrt(np.maximum(squares / m - mean * mean, 0) * m)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of q and x."""
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if largest < EXACT_FLOAT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if largest < 1 << 27:
        return q.astype(np.int64) @ x.astype(np.int64).T
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.clip(q.astype(object) @ x.astype(object).T, low, high).astype(np.int64)


class _Best:
    """The k best (score, id) of each query so far, larger score first, then smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.filled = np.zeros((queries, k), bool)

    def floor(self, rows: slice) -> np.ndarray:
        """What a candidate must reach; minus infinity while fewer than k are known."""
        return np.where(self.filled[rows, -1], self.score[rows, -1].astype(np.float64), -np.inf)

    def add(self, row: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s = np.concatenate([self.score[row][self.filled[row]], scores])
        i = np.concatenate([self.id[row][self.filled[row]], ids])
        order = np.lexsort((i, -s))
        if len(np.unique(i)) < len(i):  # an id counts once, by its best score
            order = order[np.sort(np.unique(i[order], return_index=True)[1])]
        order = order[: self.k]
        self.score[row, : len(order)], self.id[row, : len(order)], self.filled[row, : len(order)] = s[order], i[order], True


class Searcher:
    """Top k of a block of queries (id, integer vector) over batches of candidates; vectors of other lengths don't meet."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.q, self.best = ids, vectors.astype(np.float64), _Best(len(ids), k)
        self.exact = vectors
        self.levels = [segment_statistics(self.q, s) for s in RESOLUTIONS]
        self.compared = self.pairs = 0

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        xf = x.astype(np.float64)
        levels = [segment_statistics(xf, s) for s in RESOLUTIONS]
        for start in range(0, len(self.ids), QUERIES):
            rows = slice(start, min(start + QUERIES, len(self.ids)))
            self._block(rows, ids, x, levels)

    def _block(self, rows: slice, ids: np.ndarray, x: np.ndarray, levels: list) -> None:
        floor = self.best.floor(rows)
        self.pairs += len(floor) * len(ids)
        qi, xi = None, None
        for (qm, qd), (xm, xd) in zip(self.levels, levels):
            if qi is None:
                bound = qm[rows] @ xm.T + qd[rows] @ xd.T
                slack = 1e-9 * (np.abs(qm[rows]) @ np.abs(xm).T + qd[rows] @ xd.T) + 1e-6
                qi, xi = np.nonzero(bound + slack >= floor[:, None])
            else:
                a, b, c, d = qm[rows][qi], xm[xi], qd[rows][qi], xd[xi]
                bound = np.einsum("ij,ij->i", a, b) + np.einsum("ij,ij->i", c, d)
                slack = 1e-9 * (np.einsum("ij,ij->i", np.abs(a), np.abs(b)) + np.einsum("ij,ij->i", c, d)) + 1e-6
                keep = bound + slack >= floor[qi]
                qi, xi = qi[keep], xi[keep]
            if len(qi) * 4 > len(floor) * len(ids):
                break  # nothing to gain from bounds yet; the matrix product is cheaper
        self.compared += len(qi)
        if len(qi) == 0:
            return
        used, where = np.unique(xi, return_inverse=True)
        scores = exact_products(self.exact[rows], x[used])
        queries, starts = np.unique(qi, return_index=True)  # qi is sorted
        for r, begin, end in zip(queries, starts, [*starts[1:], len(qi)]):
            mine = where[begin:end]
            s, i = scores[r, mine], ids[used[mine]]
            keep = (s >= floor[r]) & (i != self.ids[rows][r])
            if keep.any():
                self.best.add(rows.start + int(r), s[keep], i[keep])

    def rows(self) -> pd.DataFrame:
        q, j = np.nonzero(self.best.filled)
        return pd.DataFrame({"query_id": self.ids[q], "vec_id": self.best.id[q, j], "score": self.best.score[q, j]})


def _search(k: int, block):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        searchers = {}
        for dim, (ids, vectors) in block.value.items():
            searchers[dim] = Searcher(np.array(ids, np.int64), np.array(vectors, np.int64), k)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.iloc[start : start + ROWS]
                for dim, group in part.groupby(part["v"].map(len)):
                    if dim in searchers:
                        searchers[dim].add(group["vec_id"].to_numpy(np.int64), np.array(list(group["v"]), np.int64))
        for s in searchers.values():
            yield s.rows()

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query with all other rows.

    Components become floor(scale * x). Queries are the rows whose id is divisible by
    `every`. Ties go to the smaller id. Vectors that are null or empty or hold a null or
    non-finite component take no part, nor do rows without an id. Only vectors of equal
    length meet. A row with the query's own id is not its candidate; an id that repeats
    with other rows counts once, by its best score, and as a query all its vectors are
    tried, each candidate by its best score with any of them. Other columns are not read; an empty
    table gives an empty result.

    Queries go out in blocks of QUERY_BLOCK, which bounds what a task or the driver holds;
    candidates stay where they are. Each task returns k rows a query.
    """
    spark = vectors.sparkSession
    whole = vectors.where(valid(embedding) & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), scaled(embedding).alias("v"))
    queries = whole.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    schema = "query_id long, vec_id long, score long"
    found = spark.createDataFrame([], schema)
    last = None
    while True:
        block = queries
        if last is not None:
            v = F.array(*[F.lit(x).cast("long") for x in last["v"]])
            block = queries.where((F.col("vec_id") > last["vec_id"]) | (F.col("vec_id") == last["vec_id"]) & (F.col("v") > v))
        block = block.orderBy("vec_id", "v").limit(QUERY_BLOCK).collect()
        if not block:
            break
        last = block[-1]
        by_length: dict[int, tuple[list, list]] = {}
        for row in block:
            ids, rows = by_length.setdefault(len(row["v"]), ([], []))
            ids.append(row["vec_id"])
            rows.append(row["v"])
        found = found.unionByName(whole.mapInPandas(_search(k, spark.sparkContext.broadcast(by_length)), schema))
        if len(block) < QUERY_BLOCK:
            break
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
