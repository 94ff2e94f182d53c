"""Embedding whitening by shifted CholeskyQR.

The centred rows form a tall matrix A. A Gram pass sums A'A in tasks; its
Cholesky factor R, with a small shift on the diagonal that keeps an
ill-conditioned matrix positive, turns A into A R^-1 by a triangular solve.
Two or more such passes, each over rows solved against the factor so far,
make the columns orthogonal to working precision, and the product of the
factors is the R of A = QR. The singular value decomposition of that small
matrix gives A's right singular vectors, the components, and its singular
values, whose squares over n are the variances. A'A itself is never
decomposed, so small components keep their digits.

Rows are never collected: a task adds up its rows, tasks' sums are added per
matrix row, and the driver holds matrices of dimension x dimension only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.matrices import LINE_DDL, matrix_lines, summed_matrix
from paxflow.llm.memory import frees_memory

COMPONENTS = 32
SCALE = 64
OFFSET = 1_000_000
# Entries beyond this size become it (after scaling), so that sums stay exact.
LARGEST = 1 << 40
# Gram passes: at least three, more only while the columns are not yet orthogonal.
LEAST_PASSES, MOST_PASSES = 3, 6
ORTHOGONAL = 1e-13
# Directions whose variance is below this share of the largest are rounding noise of a rank-deficient matrix.
RANK_SHARE = 1e-18
ROWS_AT_ONCE = 4096


@dataclass(frozen=True)
class Whitening:
    """What the passes found; arrays are by dimension."""

    n: int
    sums: tuple[int, ...]  # exact sums of the scaled rows
    components: np.ndarray  # (components, dimension), unit rows
    variances: np.ndarray  # per component, falling
    total: float  # trace of the covariance

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole parts are subtracted as integers first."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)^2, exactly."""
        n, whole = self.n, np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % n for s in self.sums]
        z = x - whole
        widest = int(np.abs(z).max(initial=0))
        if max(widest, 1) * max(widest, n) * self.dimension < 1 << 62:
            squares = (z * z).sum(axis=1).tolist()
            mixed = (z * np.array(rest, np.int64)).sum(axis=1).tolist()
        else:
            squares = [sum(v * v for v in row) for row in z.tolist()]
            mixed = [sum(v * r for v, r in zip(row, rest, strict=True)) for row in z.tolist()]
        own = sum(r * r for r in rest)
        return [n * n * a - 2 * n * b + own for a, b in zip(squares, mixed, strict=True)]

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components.T) / np.sqrt(self.variances)


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds finite entries only."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.coalesce(value.isNotNull() & finite, F.lit(False))


def _scaled(batch: pa.RecordBatch, column: int, dimension: int) -> np.ndarray:
    """The batch's vectors as whole numbers, (rows, dimension)."""
    lists = batch.column(column)
    values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.float64)
    # floor of a scaled double is exact; entries far outside any embedding are bounded
    return np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dimension: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            yield part, _scaled(part, column, dimension)


def _fit_list(rows: DataFrame, vector_col: str) -> tuple[DataFrame, int]:
    """Usable rows of the usual dimension, and that dimension (0: no rows)."""
    kept = rows.filter(usable(F.col(vector_col))).withColumn(vector_col, F.col(vector_col).cast("array<double>"))
    kept = kept.filter(F.size(vector_col) > 0)
    usual = kept.groupBy(F.size(vector_col).alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    found = usual.orderBy(F.col("rows").desc(), F.col("d").desc()).first()
    if found is None:
        return kept, 0
    return kept.filter(F.size(vector_col) == found["d"]), found["d"]


def _sums(kept: DataFrame, vector_col: str, dimension: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows and the exact sums of the scaled rows."""

    @frees_memory
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for part, x in _blocks(batches, 0, dimension):
            n += part.num_rows
            low += (x & 0xFFFFFF).sum(axis=0)  # two limbs: no overflow at any number of rows
            high += (x >> 24).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()), pa.array(low), pa.array(high)],
                ["at", "n", "low", "high"],
            )

    parts = kept.select(vector_col).mapInArrow(add, "at int, n bigint, low bigint, high bigint")
    found = parts.groupBy("at").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "low", "high")]).collect()
    rows = sorted(found, key=lambda r: r["at"])
    return int(rows[0]["n"]), tuple(int(r["low"]) + (int(r["high"]) << 24) for r in rows)


def _gram(kept: DataFrame, vector_col: str, dimension: int, of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of b'b over all rows b = of(x), added up per task, then per matrix row."""

    @frees_memory
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), 0
        for part, x in _blocks(batches, 0, dimension):
            block = of(x)
            total += block.T @ block
            rows += part.num_rows
        if rows:
            yield from matrix_lines(total)

    return summed_matrix(kept.select(vector_col).mapInArrow(add, LINE_DDL), width)


def _solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, by substitution column by column."""
    out = np.array(rows, np.float64)
    for k in range(upper.shape[0]):
        if k:
            out[:, k] -= out[:, :k] @ upper[:k, k]
        out[:, k] /= upper[k, k]
    return out


def _factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of the Gram matrix plus a shift; the shift grows until the matrix is positive."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift *= 16


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """(the fit list, its whitening): vectors that are null, empty, or hold a
    null or non-finite entry are dropped, and those whose length is not the
    most frequent one (of equally frequent ones the longest). None without
    rows or without variance."""
    kept, d = _fit_list(rows, vector_col)
    if not d:
        return kept, None
    n, sums = _sums(kept, vector_col, d)
    centre = Whitening(n, sums, np.empty((0, d)), np.empty(0), 0.0)
    first = _gram(kept, vector_col, d, centre.centred, d)
    norm = float(np.trace(first))
    if norm <= 0:
        return kept, None
    unit = np.finfo(float).eps / 2
    r = _factor(first, 11 * (n * d + d * (d + 1)) * unit * norm / n)
    factors = [r]
    gram = first
    for step in range(1, MOST_PASSES + 1):
        solved = list(factors)

        def orthogonal(x: np.ndarray, solved=solved) -> np.ndarray:
            block = centre.centred(x)
            for factor in solved:
                block = _solve_right(block, factor)
            return block

        gram = _gram(kept, vector_col, d, orthogonal, d)
        if step >= LEAST_PASSES - 1 and np.abs(gram - np.eye(d)).max() < ORTHOGONAL:
            break
        if step == MOST_PASSES:
            break
        factor = _factor(gram, unit * d)
        factors.append(factor)
        r = factor @ r
    # A = QR with Q'Q as last measured; the identity where A has full rank.
    size, turn = np.linalg.eigh(gram)
    _, singular, right = np.linalg.svd((np.sqrt(np.maximum(size, 0))[:, None] * turn.T) @ r)
    variances = singular**2 / n
    good = variances > RANK_SHARE * variances[0]
    k = min(components, int(good.sum()))
    unit_rows = right[:k].copy()
    lead = unit_rows[np.arange(k), np.abs(unit_rows).argmax(axis=1)]
    return kept, Whitening(n, sums, unit_rows * np.sign(lead)[:, None], variances[:k], norm / n)


def identity_error(kept: DataFrame, model: Whitening, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from one more pass."""
    k, d = len(model.variances), model.dimension
    sums = _gram(kept, vector_col, d, lambda x: np.c_[model.project(x), np.ones(len(x))], k + 1)
    mean = sums[:k, k] / model.n
    return float(np.abs(sums[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


_WHITE = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row per kept row and component: vec_id, component (from 1, by
    falling variance), n, deviation, whitened, explained, identity_error.

    See :func:`fit` for rows that are dropped. Directions without variance
    have no component (fewer than 32 then). Rows that share an id are rows of
    their own; a null id stays null. ``deviation`` is null where it does not
    fit a long. Entries beyond 2**40 after scaling count as that. No usable
    row, or no variance at all, gives an empty result; other columns are left
    alone.
    """
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    kept, model = fit(own, "vector")
    if model is None:
        return rows.sparkSession.createDataFrame([], _WHITE)
    error = identity_error(kept, model, "vector")
    k, d = len(model.variances), model.dimension
    explained = model.variances / model.total

    @frees_memory
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1, d):
            m = part.num_rows
            deviations = [v if v < 1 << 63 else None for v in model.deviations(x)]
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    pa.array(deviations, pa.int64()).take(each),
                    pa.array(model.project(x).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return kept.select("vec_id", "vector").mapInArrow(project, _WHITE)
