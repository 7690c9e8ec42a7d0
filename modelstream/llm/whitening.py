"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes.

Entries become integers, so the count and the sums per dimension are exact and every centred value (n * x - S) / n is
rounded once. The covariance itself is never formed: a pass multiplies the centred rows with a block Q of `wanted` +
`GUARD` columns, in tasks, and adds up Xᵀ(XQ) / n, a matrix of dimensions x columns.

A round applies the Chebyshev polynomial of degree `DEGREE` that is small on the unwanted part of the spectrum, from 0 to the
smallest Ritz value of the block, by its three-term recurrence, one pass a term. QR and one more pass give the Ritz vectors and their
residuals. A component is certified when its residual, over the gap to the rest of the spectrum, bounds its angle to the
true eigenvector by `ANGLE`, or when it is at the level of rounding. Where a round gains too little, the block is doubled; a block of all
dimensions is exact at once, so the iteration always ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm.common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
GUARD = 16
DEGREE = 10
# Bound of the angle between a component and its eigenvector, and what rounding leaves of a residual relative to the largest eigenvalue.
ANGLE = 1e-11
ROUNDING = 4e-15
MOST_ROUNDS = 40
# Partial sums of tasks are added in so many groups before they meet on the driver.
MERGERS = 64
ROWS = 4096
# Largest absolute value for which sums of `ROWS` rows stay exact in 64 bits.
PLAIN = 1 << 50

WHITE = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def matrix_of(column: pa.Array, kind) -> np.ndarray:
    """A list column without nulls, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (array<bigint>) of every row whose vector can be used: not null, not empty, all entries finite.

    Entries beyond 2**62 / `SCALE`, which a long cannot hold when scaled, count as that bound.
    """
    far = F.lit(float(1 << 62))
    entries = F.col("v")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .filter(F.col("v").isNotNull() & (F.size("v") > 0))
        .filter(finite)
        .select("vec_id", F.transform("v", lambda c: F.floor(F.greatest(F.least(c * SCALE, far), -far)) + SHIFT).alias("x"))
    )


def _sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows and sums per dimension of a task, as decimal text."""
    total: list[int] = []
    for batch in source:
        for low in range(0, batch.num_rows, ROWS):
            x = matrix_of(batch.column(0).slice(low, ROWS), np.int64)
            plain = x.min() > -PLAIN and x.max() < PLAIN
            part = (x if plain else x.astype(object)).sum(axis=0)
            part = [len(x), *map(int, part)]
            total = [a + b for a, b in zip(total, part)] if total else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), pa.int32()), pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], ["at", "total"]
    )


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S per entry, exact: 64-bit integers, or Python's where they do not hold it."""
    most = max(abs(int(x.min())), abs(int(x.max())), 1)
    if n * most + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(d: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, exact; null where a long cannot hold one."""
    most = int(np.abs(d).max()) if d.size else 0
    if d.dtype != object and most * most * d.shape[1] < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    found = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in found]


class Spread:
    """The covariance of stored integer vectors as an operator: products with a block of columns, each a pass over the rows."""

    def __init__(self, x: DataFrame, n: int, sums: list[int]):
        self.x, self.n, self.sums, self.dimensions, self.passes = x, n, sums, len(sums), 0

    def _summed(self, task, height: int, width: int) -> np.ndarray:
        """The sum over tasks of the matrices that `task` makes of the batches."""
        self.passes += 1

        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((height, width))
            for batch in source:
                for low in range(0, batch.num_rows, ROWS):
                    total += task(matrix_of(batch.column(0).slice(low, ROWS), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = sorted(p for batch in source for p in batch.column(0).to_pylist())
            if parts:
                total = np.sum([np.frombuffer(p).reshape(height, width) for p in parts], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        parts = self.x.select("x").mapInArrow(run, "part binary")
        if parts.rdd.getNumPartitions() > MERGERS:
            parts = parts.repartitionById(MERGERS, F.spark_partition_id() % MERGERS).mapInArrow(add, "part binary")
        found = sorted(bytes(r.part) for r in parts.collect())
        return np.sum([np.frombuffer(p).reshape(height, width) for p in found], axis=0)

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: a pass that centres each row before it multiplies."""
        n, sums = self.n, self.sums

        def task(x):
            c = centred(x, n, sums).astype(float) / n
            return c.T @ (c @ q)

        return self._summed(task, *q.shape) / n

    def second_moments(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and mean product of the projections on the columns of q, the mean taken out."""
        n, sums, width = self.n, self.sums, q.shape[1]

        def task(x):
            w = centred(x, n, sums).astype(float) / n @ q
            return np.vstack([w.T @ w, w.sum(axis=0)])

        both = self._summed(task, width + 1, width) / n
        return both[width], both[:width] - np.outer(both[width], both[width])

    def trace(self) -> float:
        n, sums = self.n, self.sums
        return float(self._summed(lambda x: np.array([[np.square(centred(x, n, sums).astype(float) / n).sum()]]), 1, 1)[0, 0]) / self.n


def filtered(spread: Spread, q: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """p(V) q for the Chebyshev polynomial p that is at most 1 on [0, cut], scaled to be 1 near `top`."""
    middle = half = cut / 2
    sigma = first = half / (middle - top)
    before, now = q, (spread.times(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (spread.times(now) - middle * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def ritz(spread: Spread, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Falling Ritz values of the block, their vectors and residual norms: one pass."""
    q, _ = np.linalg.qr(q)
    product = spread.times(q)
    small = q.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, q @ turn, np.linalg.norm(product @ turn - q @ turn * values, axis=0)


def certified(values: np.ndarray, residuals: np.ndarray, wanted: int, complete: bool) -> bool:
    """Whether the angles of the wanted components to their eigenvectors are within `ANGLE`, as far as rounding shows.

    The distance to the other eigenvalues is that to the next Ritz values less their residuals; equal values have no eigenvectors
    of their own, and any basis of their space is one.
    """
    if complete:
        return True
    floor = ROUNDING * max(values[0], 0.0) * len(values)
    for i in range(wanted):
        if residuals[i] <= floor:
            continue
        near = [abs(values[i] - values[j]) - residuals[j] for j in (i - 1, i + 1) if 0 <= j < len(values)]
        if residuals[i] > ANGLE * max(min(near), 0.0):
            return False
    return True


def top_components(spread: Spread, wanted: int = COMPONENTS, guard: int = GUARD, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of the covariance, falling, and their unit vectors as columns; fewer if its rank is lower."""
    size = spread.dimensions
    wanted = min(wanted, size)
    width = min(size, wanted + guard)
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((size, width))
    values, block, residuals = ritz(spread, block)
    rounds = 0
    while not certified(values, residuals, wanted, width == size):
        if values[0] <= 0 or rounds >= MOST_ROUNDS or width < size and values[-1] <= ROUNDING * values[0]:
            # Nothing left to damp, or too slow: more columns.
            width, rounds = min(size, 2 * width), 0
            block = np.hstack([block, rng.standard_normal((size, width - block.shape[1]))])
            values, block, residuals = ritz(spread, block)
            continue
        worst = residuals[:wanted].max()
        values, block, residuals = ritz(spread, filtered(spread, block, values[-1], values[0], DEGREE))
        rounds += 1
        if residuals[:wanted].max() > worst / 4 and rounds > 3 and residuals[:wanted].max() > ROUNDING * values[0] * width:
            rounds = MOST_ROUNDS
    holds = values[:wanted] > ROUNDING * size * max(values[0], 0.0)
    vectors = block[:, :wanted][:, holds]
    # A sign of its own for each column, the same in every run.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[:wanted][holds], vectors


def whitened(vectors: DataFrame, wanted: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    All usable vectors are the fit list, repeated ones as often as they occur; null, empty, or not finite vectors are left out
    and so are those whose length is not the most frequent one (of equally frequent the largest). Components without variance are
    not returned, so a table of equal vectors, like an empty one, gives an empty result. Null ids stay null. A deviation that a
    long cannot hold is null. Other columns are not looked at. Matrices of dimensions x block pass through the driver; rows never do.
    """
    spark = vectors.sparkSession
    usable = stored(integer_vectors(vectors, id_col, vector_col), "white-vectors")
    lengths = usable.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size"))
    usual = lengths.first()
    if usual is None:
        return spark.createDataFrame([], WHITE)
    x = usable.filter(F.size("x") == usual["size"])
    sums = x.select("x").mapInArrow(_sums, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total"))
    n, *totals = (int(r.total) for r in sums.orderBy("at").collect())
    spread = Spread(x, n, totals)
    values, basis = top_components(spread, wanted)
    if not len(values):
        return spark.createDataFrame([], WHITE)
    scaled = basis / np.sqrt(values)
    _, covariance = spread.second_moments(scaled)
    error = float(np.abs(covariance - np.eye(len(values))).max())
    explained = values / spread.trace()
    count = len(values)

    def rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for low in range(0, batch.num_rows, ROWS):
                ids = batch.column(0).slice(low, ROWS)
                d = centred(matrix_of(batch.column(1).slice(low, ROWS), np.int64), n, totals)
                projected = d.astype(float) / n @ scaled
                own = np.repeat(np.arange(len(ids)), count)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(own)),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(ids))),
                        pa.array(np.full(len(own), n, np.int64)),
                        pa.array(deviations(d), pa.int64()).take(pa.array(own)),
                        pa.array(projected.ravel()),
                        pa.array(np.tile(explained, len(ids))),
                        pa.array(np.full(len(own), error)),
                    ],
                    [c.split()[0] for c in WHITE.split(", ")],
                )

    return x.select("vec_id", "x").mapInArrow(rows, WHITE)
