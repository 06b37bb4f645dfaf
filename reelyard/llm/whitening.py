"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

The matrix X holds the distinct quantised vectors, centred, one to a row; it stays a stored, distributed table.  From a
unit vector v of the embedding's dimension, steps alternate the two products:

    u_k = (X v_k - U c) / alpha_k          left vectors, orthogonal to all earlier ones
    v_k+1 = (X' u_k - V d) / beta_k        right vectors, orthogonal to all earlier ones

Both sides are fully reorthogonalised.  U is as long as the table, so it is never gathered: every left vector is X times
a short vector p (``u_k = X p_k``), each task recomputes its rows of U from its rows of X, and a pass over the table
returns the sums ``X'y``, ``U'y`` and ``y'y`` for ``y = X v`` as one short row a task, added up by Spark.  Where the
orthogonalisation cancels most of y, the pass is made again with the corrected vector.  The driver holds only vectors of
the embedding's dimension, the small bidiagonal matrix, and its singular value decomposition, whose right vectors give
the components; squared singular values over n are the eigenvalues of the covariance.

Steps end when the wanted components no longer change (their residual is at rounding level) or the space is exhausted,
after at most as many steps as there are dimensions.

Defined results.  Rows whose vector is null, or holds a null or non-finite entry, are dropped, as are rows with an entry
beyond ``LARGEST`` in size (they have no quantised long) and rows shorter than the longest vector (they lack entries).
Repeated vectors count once in the fit and each of their rows is whitened.  Components whose eigenvalue is below
``RANK`` of the largest do not exist in double precision and give no rows; a table with fewer than two distinct vectors
gives an empty result.  Of the two signs of a component the one with a positive largest entry is used.  ``deviation`` is
an exact long, null where it exceeds one.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.llm.common import map_arrow, store

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16
RANK = 1e-13
#: A residual at this share of the largest singular value ends the steps.
SETTLED = 1e-14
#: An orthogonalised vector shorter than this share of the original one is made again.
AGAIN = 0.01


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: the usable rows with entries ``floor(64 c) + 1000000`` as longs."""
    entries = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    usable = F.size("c") > 0
    usable &= F.coalesce(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)), F.lit(False))
    rows = entries.where(F.col("c").isNotNull() & usable)
    x = F.transform("c", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))
    return rows.select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, size)


def _added(rows: DataFrame, size: int, fn, width: int) -> np.ndarray:
    """The sum over all batches of ``fn(matrix of longs)``, a vector of ``width`` doubles: one short row a task, added by Spark."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += fn(_matrix(batch.column("x"), size))
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["s"])

    sums = map_arrow(rows, part, "s array<double>").select(F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    out = np.zeros(width)
    for r in sums.collect():  # ``width`` rows: a few times the embedding's dimension
        out[r["at"]] = r["s"]
    return out


@dataclass
class Whitener:
    """A fitted transformation: ``n`` distinct vectors, their sums, components as columns, eigenvalues, share of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float
    steps: int = 0


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S/n``, from the exact long ``n x - S``."""
    return (n * x - sums) / n


def bidiagonalise(rows: DataFrame, n: int, sums: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Right singular vectors (columns) and singular values of the centred rows, largest first, and the steps taken."""
    size = len(sums)
    v = np.random.default_rng(7).standard_normal(size)
    v /= np.linalg.norm(v)
    right, left, products = [v], [], []  # v_k, p_k (u_k = X p_k), X'u_k
    alphas, betas = [], []

    def product(w: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """``X'y``, ``U'y`` and ``y'y`` for ``y = X w`` and ``U = X p``."""
        k = p.shape[1]

        def block(x):
            c = _centred(x, n, sums)
            y = c @ w
            return np.concatenate([c.T @ y, (c @ p).T @ y, [y @ y]])

        got = _added(rows, size, block, size + k + 1)
        return got[:size], got[size:-1], float(got[-1])

    while True:
        p = np.array(left).T if left else np.zeros((size, 0))
        t = np.array(products).T if products else np.zeros((size, 0))
        w = right[-1]
        for _ in range(3):
            xty, uty, yy = product(w, p)
            rest = yy - uty @ uty
            w, xty = w - p @ uty, xty - t @ uty
            if rest > AGAIN * yy:
                break
        if rest <= 0 or (alphas and rest <= (RANK * max(alphas)) ** 2):
            break  # X v lies in the left vectors' space: the last right vector has no left one
        alpha = np.sqrt(rest)
        alphas.append(alpha)
        left.append(w / alpha)
        products.append(xty / alpha)
        v_all = np.array(right).T
        r = products[-1].copy()
        for _ in range(2):
            r -= v_all @ (v_all.T @ r)
        beta = np.linalg.norm(r)
        k = len(alphas)
        b = np.diag(alphas) + np.diag(betas, 1)
        q, s, _ = np.linalg.svd(b)
        settled = np.all(beta * np.abs(q[-1, : min(wanted, k)]) <= SETTLED * s[0])
        if k == size or beta <= SETTLED * s[0] or (k > wanted and settled):
            break
        betas.append(beta)
        right.append(r / beta)
    if not alphas:
        return np.zeros((size, 0)), np.zeros(0), 0
    k, r = len(alphas), len(right)
    b = np.zeros((k, r))
    b[range(k), range(k)] = alphas
    b[range(r - 1), range(1, r)] = betas
    _, s, z = np.linalg.svd(b, full_matrices=False)
    return np.array(right).T @ z.T, s, k


def fit(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Whitener | None]:
    """The usable rows (``vec_id, x``, stored) and the transformation fitted on their distinct vectors (None: no variance)."""
    rows = store(quantised(vectors, vec_id, vector))
    size = rows.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return rows, None
    rows = rows.where(F.size("x") == size)
    distinct = store(rows.select("x").distinct())
    # Exact sums; a row for each dimension.
    totals = distinct.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s"), F.count("*").alias("n")).orderBy("at").collect()
    n, sums = totals[0]["n"], np.array([r["s"] for r in totals], dtype=np.int64)
    found, singular, steps = bidiagonalise(distinct, n, sums, components)
    strong = int(np.sum(singular[:components] ** 2 > RANK * singular[0] ** 2)) if len(singular) else 0
    if not strong:
        return rows, None
    found, e = found[:, :strong], singular[:strong] ** 2 / n
    found *= np.sign(found[np.abs(found).argmax(axis=0), range(strong)])
    turn = found / np.sqrt(e)

    def check(x):  # the whitened rows' sums, products and the centred rows' squares
        c = _centred(x, n, sums)
        z = c @ turn
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel(), [np.sum(c * c)]])

    got = _added(distinct, len(sums), check, strong + strong * strong + 1)
    mean = got[:strong] / n
    covariance = got[strong:-1].reshape(strong, strong) / n - np.outer(mean, mean)
    error = float(np.abs(covariance - np.eye(strong)).max())
    return rows, Whitener(n, sums.tolist(), found, e, e / (got[-1] / n), error, steps)


REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_LONG = 2**63 - 1


def _deviations(d: np.ndarray) -> pa.Array:
    """Exact sums of squares of the rows of ``d`` as longs, null beyond."""
    if not d.size or np.square(d.astype(np.float64)).sum(axis=1).max() < 2.0**62:
        return pa.array(np.square(d).sum(axis=1, dtype=np.int64))
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return pa.array([e if e <= _LONG else None for e in exact], pa.int64())


def report(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row and component (numbered from 1 by falling eigenvalue)."""
    rows, model = fit(vectors, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], REPORT)
    n, sums = model.n, np.array(model.sums, dtype=np.int64)
    turn = model.components / np.sqrt(model.eigenvalues)
    explained, error, k = model.explained, model.identity_error, len(model.eigenvalues)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            d = n * _matrix(batch.column("x"), len(sums)) - sums
            at = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 _deviations(d).take(pa.array(at)), pa.array((d / n @ turn).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                [f.split()[0] for f in REPORT.split(", ")],
            )

    return map_arrow(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x"), whiten, REPORT)
