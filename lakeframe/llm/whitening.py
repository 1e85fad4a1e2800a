"""Embedding whitening by shifted CholeskyQR.

Centred rows are orthogonalised in distributed passes: each pass multiplies the rows by the
inverses of the triangular factors found so far, sums the Gram matrix of the result and takes
its Cholesky factor; the first factor is shifted so that it exists for any conditioning.  The
product R of the factors carries the covariance, and its singular value decomposition gives
the components.  What leaves a task is one Gram matrix (dimensions squared); what the driver
holds is a few matrices of that size, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
PASSES = 3
EPS = float(np.finfo(np.float64).eps)
LARGEST = 1 << 46  # |64 c| below this keeps sums and products of entries exact


# --- input ------------------------------------------------------------------------------

def clean_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: integer vectors ``floor(64 c) + 1000000`` of the rows whose vector is not
    NULL and holds neither NULL nor NaN nor an infinity.  An entry beyond 2**46 / 64 raises."""
    finite = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    fits = F.forall(F.col("v"), lambda c: F.abs(c) * SCALE < F.lit(float(LARGEST)))
    whole = F.transform(F.col("v"), lambda c: (F.floor(c * SCALE) + SHIFT).cast("long"))
    found = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    too_large = F.raise_error(F.lit("embedding entry too large to whiten exactly")).cast("array<bigint>")
    # One expression, so that no reordering of filters lets a row that goes reach the error.
    x = F.when(F.col("v").isNull() | ~finite, F.lit(None).cast("array<bigint>")).when(fits, whole).otherwise(too_large)
    return found.select("vec_id", x.alias("x")).where("x IS NOT NULL")


def usual_size(vectors: DataFrame) -> int:
    """The most frequent number of dimensions (of ties the largest); 0 for an empty table."""
    sizes = vectors.groupBy(F.size("x").alias("d")).count().where("d > 0")
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def _matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


# --- distributed sums -------------------------------------------------------------------

def exact_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""
    each = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(28,0)")).alias("s"))
    found = {r["i"]: r for r in each.collect()}  # one row a dimension
    return found[0]["n"], [int(found[i]["s"]) for i in range(d)]


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n`` through the exact integers ``n x - S``, taken around the rounded mean so that
    they stay small; exact up to the one division."""
    base = sums // n  # of Python integers
    rest = (sums - base * n).astype(np.float64) / n
    return (x - base.astype(np.int64)).astype(np.float64) - rest


def gram(vectors: DataFrame, d: int, width: int, project: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``y y'`` for ``y = project(x)``.  A task sums its rows in numpy, then
    Spark adds up the tasks' matrices entry by entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for batch in batches:
            if batch.num_rows:
                y, seen = project(_matrix(batch.column(0), d)), True
                total += y.T @ y
        if seen:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    parts = vectors.select("x").mapInArrow(run, "i int, j int, v double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # width squared / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


# --- shifted CholeskyQR -----------------------------------------------------------------

def shifted_cholesky(g: np.ndarray, shift: bool) -> np.ndarray:
    """Upper factor of ``g``, plus a multiple of the identity of the size of rounding errors if
    ``shift``, or where the factor does not exist without one."""
    d = len(g)
    step = 11 * d * (d + 1) * EPS * max(float(np.trace(g)) / d, np.finfo(float).tiny)
    add = step if shift else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + add * np.eye(d)).T
        except np.linalg.LinAlgError:
            add = max(step, add * 10)


def _inverse(upper: np.ndarray) -> np.ndarray:
    """Inverse of an upper triangular matrix by back substitution."""
    d = len(upper)
    out = np.zeros((d, d))
    for i in reversed(range(d)):
        out[i, i] = 1 / upper[i, i]
        out[i, i + 1:] = -(upper[i, i + 1:] @ out[i + 1:, i + 1:]) / upper[i, i]
    return out


def triangular_solve(rows: np.ndarray, inverses: list[np.ndarray]) -> np.ndarray:
    """Rows times the inverse of each factor in turn (rows of Q)."""
    for inverse in inverses:
        rows = rows @ inverse
    return rows


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``z = (x - sums / n) @ components.T / sqrt(eigenvalues)``."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # of the components, falling
    components: np.ndarray  # (components, dimensions), unit rows
    trace: float
    factors: list[np.ndarray]

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centre(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, np.array(self.sums, dtype=object))

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.components.T / np.sqrt(self.eigenvalues)


def fit(vectors: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> Whitening | None:
    """Whitening of ``vectors`` (``x`` of equal size), None where there is no row.  A direction in
    which the rows do not vary (beyond rounding) is no component."""
    d = usual_size(vectors)
    if not d:
        return None
    vectors = vectors.where(F.size("x") == d)
    n, sums = exact_sums(vectors, d)
    exact = np.array(sums, dtype=object)
    factors, inverses, r, trace = [], [], np.eye(d), 0.0
    for turn in range(passes):
        solved = list(inverses)  # what this pass's tasks carry
        g = gram(vectors, d, d, lambda x: triangular_solve(_centred(x, n, exact), solved))
        if turn == 0:
            trace = float(np.trace(g)) / n
            if trace == 0:
                return Whitening(n, sums, np.empty(0), np.empty((0, d)), 0.0, [])
        factor = shifted_cholesky(g, shift=turn == 0)
        factors.append(factor)
        inverses.append(_inverse(factor))
        r = factor @ r
    _, sigma, right = np.linalg.svd(r)
    varies = sigma > d * 64 * EPS * sigma[0]
    kept = right[varies][:components]
    kept = kept * np.where(np.take_along_axis(kept, np.abs(kept).argmax(axis=1)[:, None], 1) < 0, -1.0, 1.0)
    return Whitening(n, sums, sigma[varies][:components] ** 2 / n, kept, trace, factors)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, in one
    more pass; a column of ones beside them sums the means."""
    k = len(model.eigenvalues)
    g = gram(vectors, model.dimensions, k + 1, lambda x: np.column_stack([model.whiten(x), np.ones(len(x))]))
    mean = g[:k, k] / model.n
    return float(np.abs(g[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal]:
    """Sum over dimensions of ``(n x - S)**2``, exact at any number of rows."""
    base = sums // n
    rest = sums - base * n  # n x - S = n (x - base) - rest
    moved = x - base.astype(np.int64)
    if ((int(np.abs(moved).max(initial=0)) + 1) * n) ** 2 * len(sums) < 1 << 63:
        return [Decimal(v) for v in ((moved * n - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()]
    # n**2 sum m**2 - 2 n sum m r + sum r**2 in whole numbers of any size
    squares = (moved.astype(object) ** 2).sum(axis=1)
    mixed = (moved.astype(object) * rest).sum(axis=1)
    return [Decimal(int(n * n * a - 2 * n * b + int((rest * rest).sum()))) for a, b in zip(squares, mixed)]


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, deviation`` (exact, decimal) and ``whitened`` (an array) of each row of the fitted size."""
    d, n, exact = model.dimensions, model.n, np.array(model.sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            z = np.ascontiguousarray(model.whiten(x))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_deviation(x, n, exact), pa.decimal128(38, 0)), lists],
                                             names=["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.where(F.size("x") == d).select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining row and component (from 1, by falling eigenvalue): ``vec_id, component,
    n, deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL or holds a NULL or non-finite entry go, as do vectors of another
    than the most frequent number of dimensions (empty ones included).  Repeated rows count as
    often as they occur; NULL ids stay.  Components are at most as many as there are directions
    in which the rows vary, so equal rows, a single row and an empty table give no row.  Columns
    other than the two named play no part, whatever their names; there are no texts.  ``deviation``
    is NULL where it exceeds a long (``transform`` has it as a decimal)."""
    vectors = clean_vectors(rows, id_col, vector_col)
    model = fit(vectors, components)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    error = identity_error(vectors.where(F.size("x") == model.dimensions), model)
    share: Column = F.lit([float(e / model.trace) for e in model.eigenvalues])
    out = transform(vectors, model).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
    out = out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
