"""Whitening of vectors on their leading principal components, found by Jacobi-Davidson.

The covariance matrix is never formed: each step multiplies it with a block of vectors in a
Spark job over the distinct vectors, whose tasks return sums of the block's size. For all wanted
components at once, the projected correction equations are solved by a few steps of MINRES, the
search space grows by the corrections, and a Rayleigh-Ritz step in it gives the next approximations. Components
whose residual is at rounding level are locked, and what follows stays orthogonal to them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from acoustic_spark.llm.common import fresh, written

#: Entries become floor(SCALE * c) + SHIFT; larger entries than LARGEST count as non-finite.
SCALE, SHIFT, LARGEST = 64, 1_000_000, float(1 << 40)
COMPONENTS = 16
#: Vectors of a stored block.
BLOCK = 4096
#: Groups in which the tasks' sums are added up; so many come to the driver.
SLOTS = 32
#: Approximations kept besides the wanted ones, steps of MINRES for a correction, and its wanted reduction.
EXTRA, INNER, REDUCED = 4, 6, 0.01
#: Residuals, relative to the largest eigenvalue, that count as rounding; eigenvalues that count as zero.
ROUNDING, ZERO = 1e-13, 1e-10
#: Search space in blocks of the wanted size before it is cut to the leading approximations.
RESTART = 5

Product = Callable[[np.ndarray], np.ndarray]


def _blocks(dims: int) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(-1, dims)
            for begin in range(0, len(x), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([x[begin : begin + BLOCK].tobytes()], pa.binary())], names=["vectors"])

    return run


def _sums(dims: int) -> object:
    """Count (dim -1) and sum by dimension, of any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for vectors in batch["vectors"]:
                x = np.frombuffer(vectors, np.int64).reshape(-1, dims)
                high, low = (x >> 20).sum(axis=0).tolist(), (x & 0xFFFFF).sum(axis=0).tolist()
                yield pd.DataFrame({"dim": range(-1, dims), "s": [str(v) for v in [len(x), *(h * (1 << 20) + w for h, w in zip(high, low))]]})

    return run


class Centre:
    """The mean S / n as whole numbers and rests, so that nothing cancels when it is taken from x."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.whole, self.rest = n, np.array([s // n for s in sums], np.int64), [s % n for s in sums]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S) ** 2 of each row, exact; None where it is no BIGINT."""
        around = x - self.whole
        size = (int(np.abs(around).max(initial=0)) + 1) * self.n
        if size * size * x.shape[1] < 1 << 62:
            return ((self.n * around - np.array(self.rest)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * around.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in exact]


def total(blocks: DataFrame, centre: Centre, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of a flat array over all blocks of centred vectors: added up within tasks, then in SLOTS groups of tasks, then here."""
    dims = len(centre.whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for vectors in batch["vectors"].to_pylist():
                part = of(centre(np.frombuffer(vectors, np.int64).reshape(-1, dims)))
                out = part if out is None else out + part
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.tolist()], pa.list_(pa.float64()))], names=["part"])

    def summed(group: pa.Table) -> pa.Table:
        parts = group["part"].combine_chunks().flatten().to_numpy().reshape(group.num_rows, -1)
        return pa.table({"part": pa.array([parts.sum(axis=0).tolist()], pa.list_(pa.float64()))})

    parts = blocks.mapInArrow(run, "part array<double>").withColumn("slot", F.spark_partition_id() % SLOTS)
    rows = parts.groupBy("slot").applyInArrow(summed, "part array<double>").collect()
    return np.sum([r["part"] for r in rows], axis=0)


def minres(apply: Product, rhs: np.ndarray, steps: int, reduced: float) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column, that share each product."""
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    goal, eta = reduced * beta, beta.copy()
    one, zero = np.ones_like(beta), np.zeros_like(beta)
    divided = lambda a, b: np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 0)
    v, v_old, w, w_old = divided(rhs, beta), np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    cos, cos_old, sin, sin_old = one, one, zero, zero
    beta = zero
    for _ in range(steps):
        av = apply(v)
        alpha = (v * av).sum(axis=0)
        next_ = av - alpha * v - beta * v_old
        beta_next = np.linalg.norm(next_, axis=0)
        a0 = cos * alpha - cos_old * sin * beta
        a1 = np.hypot(a0, beta_next)
        a2, a3 = sin * alpha + cos_old * cos * beta, sin_old * beta
        cos_old, sin_old, cos, sin = cos, sin, divided(a0, a1), divided(beta_next, a1)
        w, w_old = divided(v - a3 * w_old - a2 * w, a1), w
        x = x + cos * eta * w
        eta = -sin * eta
        v, v_old, beta = divided(next_, beta_next), v, beta_next
        if (np.abs(eta) <= goal).all():
            break
    return x


def off(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What of the columns is orthogonal to an orthonormal basis; twice, against rounding."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def new_directions(basis: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what x has besides the basis."""
    x = x / np.maximum(np.linalg.norm(x, axis=0), np.finfo(float).tiny)
    left, size, _ = np.linalg.svd(off(basis, x), full_matrices=False)
    left = off(basis, left[:, size > 1e-8])
    return np.linalg.qr(left)[0] if left.shape[1] else left


def jacobi_davidson(product: Product, dims: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors (columns) of a symmetric matrix known by its products.

    Ends when every residual is at rounding level, as seen in a fresh product, or when the
    search space is the whole space and its products are fresh, so that nothing can be added.
    """
    wanted = min(wanted, dims)
    locked, values = np.zeros((dims, 0)), np.zeros(0)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, min(dims, wanted + EXTRA))))[0]
    image, new = product(space), True
    while True:
        ritz, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        order = np.argsort(-ritz)
        ritz, space, image = ritz[order], space @ turn[:, order], image @ turn[:, order]
        left = wanted - locked.shape[1]
        largest = max(values.max(initial=0), ritz.max(initial=0))
        residual = off(locked, image - space * ritz)
        small = np.linalg.norm(residual, axis=0) <= ROUNDING * largest
        full = locked.shape[1] + space.shape[1] == dims
        done = min(left, int(np.argmin(np.append(small, False))))
        if full and new:
            done = left
        if done == left and not new:  # the images were added up over many steps: look again
            image, new = product(space), True
            continue
        if done:
            locked, values = np.hstack([locked, space[:, :done]]), np.append(values, ritz[:done])
            space, image, residual, ritz = space[:, done:], image[:, done:], residual[:, done:], ritz[done:]
            left -= done
        if not left:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        if full:
            image, new = product(space), True
            continue
        if space.shape[1] > RESTART * (wanted + EXTRA):
            space, image = space[:, : left + EXTRA], image[:, : left + EXTRA]
        against = np.hstack([locked, space[:, :left]])
        shift = ritz[:left]
        correction = minres(lambda t: off(against, product(off(against, t)) - t * shift), off(against, -residual[:, :left]), INNER, REDUCED)
        added = new_directions(np.hstack([locked, space]), correction)
        if not added.shape[1]:
            rest = np.random.default_rng(seed + space.shape[1]).standard_normal((dims, left))
            added = new_directions(np.hstack([locked, space]), rest)
        space, image, new = np.hstack([space, added]), np.hstack([image, product(added)]), False


WHITE = T.StructType([T.StructField("deviation", T.LongType()), T.StructField("values", T.ArrayType(T.DoubleType()))])


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """`vectors` with component, n, deviation, whitened, explained and identity_error: a row for each vector and component.

    Rows whose vector is null or empty or holds null, non-finite or larger entries than LARGEST take no part, nor do those
    that have another length than most (the longer, if equally many). Entries become whole numbers x. The fit list has each
    distinct x once, however many rows repeat it: n vectors with sums S. Components are unit eigenvectors of the
    list's covariance, numbered from 1 by falling eigenvalue; those of an eigenvalue below ZERO of the
    largest are left out, as they can't be scaled to variance 1 (one distinct vector alone has none, so no rows
    come back). deviation is the exact sum of (n * x - S) ** 2, null if it is no BIGINT. whitened is the projection of x - S / n
    over the root of the eigenvalue, explained the eigenvalue's share of the trace, identity_error the largest entry by which the
    covariance of the whitened fit list differs from the identity. No rows give no rows. Result columns replace input columns of the same name.
    """
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = vectors.drop(*[c for c in added if c != vector])
    x, out = fresh(vectors, "x", "out")
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(LARGEST)))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT))
    rows = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    lengths = rows.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = lengths[0]["dims"] if lengths else 0
    rows = rows.where(F.size(vector) == dims).withColumn(x, whole)
    empty = vectors.where(F.lit(False)).withColumns(dict(zip(added, [F.lit(1), F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit(1.0), F.lit(1.0), F.lit(1.0)])))
    if not dims:
        return empty

    blocks = written(rows.select(F.col(x).alias("x")).distinct().mapInArrow(_blocks(dims), "vectors binary"), "vectors")
    sums = blocks.mapInPandas(_sums(dims), "dim int, s string").groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    n, *sums = [int(r["s"]) for r in sorted(sums, key=lambda r: r["dim"])]
    centre = Centre(n, sums)

    def product(w: np.ndarray) -> np.ndarray:
        return total(blocks, centre, lambda y: (y.T @ (y @ w)).ravel()).reshape(w.shape) / n

    trace = total(blocks, centre, lambda y: np.array([(y * y).sum()]))[0] / n
    if not trace:
        return empty
    values, basis = jacobi_davidson(product, dims, components)
    values, basis = values[values > ZERO * values[0]], basis[:, values > ZERO * values[0]]
    scaled = basis / np.sqrt(values)
    k = len(values)
    moments = total(blocks, centre, lambda y: np.append((z := y @ scaled).sum(axis=0), (z.T @ z).ravel())) / n
    error = float(np.abs(moments[k:].reshape(k, k) - np.outer(moments[:k], moments[:k]) - np.eye(k)).max())

    @F.pandas_udf(WHITE)
    def projected(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"deviation": [], "values": []})
        found = np.stack(column.to_numpy())
        return pd.DataFrame({"deviation": pd.array(centre.deviations(found), "Int64"), "values": list(centre(found) @ scaled)})

    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    keep = [c for c in vectors.columns if c not in added]
    done = rows.withColumn(out, projected(F.col(x))).select(*keep, F.col(f"{out}.deviation").alias("deviation"), F.posexplode(f"{out}.values").alias("component", "whitened"))
    return done.select(
        *keep, (F.col("component") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"),
    )
