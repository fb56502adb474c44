"""Whitening of embeddings by shifted CholeskyQR.

The rows are brought to whole numbers, ``x = floor(256 c)``; the fit list holds
each distinct x once.  Its centred rows A (n x d) are never collected: a pass
over the fit list adds up the Gram matrix of the rows as they stand after the
triangular solves so far.  Each pass factors its Gram matrix,

    G + shift I = R' R,    A <- A R^-1  (a triangular solve per batch),

and the factors are composed, R_total = R_k ... R_1.  The shift makes the first
factorisation exist whatever the condition of A; further passes undo it and
bring the columns to orthogonality in double precision.  Directions without any
variance keep the shift and vanish from the composed factor (each pass shrinks
them by the root of its shift).  The singular value decomposition of R_total
gives the components: right singular vectors and ``e = s^2 / n``.

The driver holds d x d matrices only; partial Gram matrices are added up by a
grouped sum over their cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import drop_kept, hand_back_memory, written

SCALE = 256
COMPONENTS = 4
UNIT = np.finfo(np.float64).eps / 2
# Off identity by less than this, the columns count as orthonormal.
ORTHONORMAL = 1e-10
PASSES = 8
# Eigenvalues below this share of the largest are rounding errors of zero.
RANK_SHARE = 1e-13
LONG_MAX = (1 << 63) - 1
EXACT = float(1 << 62)


def whole_numbers(v: Column) -> Column:
    """floor(256 c) + 0 of each entry, as ARRAY<BIGINT>; entries beyond the
    range of BIGINT take its end."""

    def whole(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * F.lit(float(SCALE)))
        wide = F.abs(c.cast("double")) >= F.lit(2.0**55)
        end = F.when(c > 0, F.lit(LONG_MAX)).otherwise(F.lit(-LONG_MAX - 1))
        return F.when(wide, end).otherwise(scaled).cast("bigint")

    return F.transform(v, whole)


def usable(v: Column) -> Column:
    """Whether a vector holds an entry, and no NULL, NaN or infinite one."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def rows_of(column: pa.Array, d: int) -> np.ndarray:
    """A list column whose lists all have d entries as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def deviations(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """n x - S, exact: BIGINT where it fits, else Python integers."""
    widest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if widest < LONG_MAX:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def triangular_solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a R^-1 for an upper triangular R, column by column."""
    out = np.empty_like(a)
    for j in range(r.shape[0]):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def gram(fit: DataFrame, x_col: str, d: int, sums: list[int], n: int, factors: list[np.ndarray]) -> np.ndarray:
    """The Gram matrix of the centred rows after the solves by ``factors``
    (a last factor that is not square projects the rows)."""
    k = factors[-1].shape[1] if factors else d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        total = np.zeros((k, k))
        for batch in batches:
            a = deviations(rows_of(batch.column(0), d), sums, n).astype(np.float64) / n
            for r in factors:
                a = triangular_solve(a, r) if r.shape[0] == r.shape[1] and not np.tril(r, -1).any() else a @ r
            total += a.T @ a
        hand_back_memory()
        cells = pa.array(np.arange(k * k), pa.int32())
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.reshape(-1))], names=["cell", "part"])

    parts = fit.select(x_col).mapInArrow(run, "cell int, part double")
    # One row per cell: k x k numbers, whatever the number of tasks.
    cells = parts.groupBy("cell").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(k * k)
    for r in cells:
        out[r["cell"]] = r["total"]
    out = out.reshape(k, k)
    return (out + out.T) / 2


def shifted_factor(g: np.ndarray, n: int, first: bool) -> np.ndarray:
    """The upper Cholesky factor of G + shift I.  The first pass always shifts,
    by 11 (n d + d (d + 1)) u |G|; later ones only where G does not factor
    (directions without variance)."""
    d = len(g)
    norm = float(np.linalg.norm(g, 2)) or 1.0
    # With no bound on the number of rows the shift still stays small.
    shift = min(11 * (n * d + d * (d + 1)) * UNIT, 1e-6) * norm
    for s in [0.0] * (not first) + [shift * 10.0**i for i in range(8)]:
        try:
            r = np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
        if (np.diag(r) ** 2 > UNIT * norm).all():
            return r
    raise ValueError("the Gram matrix cannot be factored")


@dataclass
class Fit:
    """What the fit list says about its components."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # d x k, unit columns
    values: np.ndarray  # k eigenvalues, falling
    explained: np.ndarray
    identity_error: float


def column_sums(fit: DataFrame, x_col: str, d: int) -> tuple[int, list[int]]:
    """(rows, exact sums per dimension); cell d counts the rows.  Partial sums
    are Python integers and travel as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        total = [0] * (d + 1)
        for batch in batches:
            x = rows_of(batch.column(0), d)
            wide = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * len(x) > LONG_MAX
            sums = (x.astype(object) if wide else x).sum(axis=0).tolist()
            total = [a + int(b) for a, b in zip(total, [*sums, len(x)], strict=True)]
        parts = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), parts], names=["cell", "part"])

    parts = fit.select(x_col).mapInArrow(run, "cell int, part decimal(38,0)")
    found = {r["cell"]: int(r["total"]) for r in parts.groupBy("cell").agg(F.sum("part").alias("total")).collect()}
    return found.get(d, 0), [found.get(i, 0) for i in range(d)]


def fit_components(fit: DataFrame, x_col: str, d: int, components: int = COMPONENTS) -> Fit:
    """Passes of shifted CholeskyQR over the fit list, then the singular value
    decomposition of the composed factor."""
    n, sums = column_sums(fit, x_col, d)
    factors: list[np.ndarray] = []
    total = np.eye(d)
    for _ in range(PASSES):
        g = gram(fit, x_col, d, sums, n, factors)
        if not g.any():
            return Fit(n, sums, np.zeros((d, 0)), np.zeros(0), np.zeros(0), 0.0)
        if factors:
            # Directions without variance never become orthonormal: the
            # others must.
            values = np.linalg.eigvalsh(g)
            if np.abs(values[values > 0.5] - 1).max(initial=0) < ORTHONORMAL and not ((values > 1e-8) & (values <= 0.5)).any():
                total = shifted_factor(g, n, False) @ total
                break
        r = shifted_factor(g, n, not factors)
        factors.append(r)
        total = r @ total
    _, s, vt = np.linalg.svd(total)
    e = s**2 / n
    k = min(components, int((e > RANK_SHARE * e[0]).sum()))
    vectors, values = vt[:k].T, e[:k]
    covariance = gram(fit, x_col, d, sums, n, [vectors / np.sqrt(values)]) / n
    return Fit(n, sums, vectors, values, values / e.sum(), float(np.abs(covariance - np.eye(k)).max()))


def whiten(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per
    usable row and component, components numbered from 1.

    Rows take no part whose vector is NULL, empty or holds a NULL or
    non-finite entry, or has another length than most (ties: the longest).
    Repeated rows and rows with a NULL id are given out like any other, and
    equal vectors count once in the fit.  There are fewer components where the
    fit list has fewer directions with variance: none for an empty table or
    when all vectors are equal.  A deviation beyond BIGINT is NULL.
    """
    base = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v")))
    base = written(base.select("id", whole_numbers(F.col("v")).alias("x")), "whole-vectors")
    lengths = base.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 1
    base = base.where(F.size("x") == d)
    fitted = fit_components(written(base.select("x").distinct(), "fit-list"), "x", d, components)
    k = len(fitted.values)
    scaled = fitted.vectors / np.sqrt(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for batch in batches:
            dev = deviations(rows_of(batch.column(1), d), fitted.sums, fitted.n)
            widest = float(np.abs(dev).max(initial=0))
            exact = dev if dev.dtype == object or widest**2 * d < EXACT else dev.astype(object)
            squares = (exact * exact).sum(axis=1)
            whitened = (dev.astype(np.float64) / fitted.n) @ scaled
            m = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, fitted.n), pa.int64()),
                    pa.array([s if s <= LONG_MAX else None for s in squares.tolist()], pa.int64()).take(
                        pa.array(np.repeat(np.arange(m), k))
                    ),
                    pa.array(whitened.reshape(-1)),
                    pa.array(np.tile(fitted.explained, m)),
                    pa.array(np.full(m * k, fitted.identity_error)),
                ],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )
        hand_back_memory()

    id_type = base.schema["id"].dataType.simpleString()
    fields = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return base.mapInArrow(run, fields).withColumnRenamed("id", id_col)
