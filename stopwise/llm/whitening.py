"""Whitening by the leading principal components, found by a block Jacobi-Davidson method.

Entries are taken as whole numbers, ``floor(64 * c) + 1000000``. The covariance is that of the distinct vectors and is never formed:
``covariance @ block`` is one pass over the stored vectors, in which each task centres its rows, multiplies them with the block
and with the result again, and gives a partial sum of the block's size. The centre is exact: with n vectors of sum S, a centred
entry is (n * x - S) / n of whole numbers.

Each round of the method takes the Ritz vectors of the subspace, locks those whose residual is at rounding level, and solves for
the others the correction equation, projected against the locked and the Ritz vectors, by some steps of MINRES; the steps of all
vectors share their passes. The corrections widen the subspace, which is restarted from its Ritz vectors when it gets too wide.
The driver holds matrices of a vector's length by the width of the subspace, whatever the number of rows.

Vectors that are null, that hold null or non-finite entries or entries of 2^25 and more, or that differ in length from most take no
part. Rows without vec_id and repeated rows are rows like others. Components without variance can't be scaled and are left
out, so a table whose vectors are all equal has no result rows. A deviation that needs more than 63 bits is null.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.sources.workspace import Workspace

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 25)
COMPONENTS = 16
#: Vectors beside the wanted ones that a restart keeps; steps of a correction; width of the subspace in blocks; rounds.
SPARE = 4
STEPS = 10
WIDTH = 6
ROUNDS = 100
#: Residuals of this many units of rounding, times the root of the vector length, count as zero; a component's variance must be above.
ROUNDING = 16
#: Largest relative residual that is taken as the limit of rounding when rounds no longer lower it.
STALLED = 1e-11


class Components(NamedTuple):
    """Unit eigenvectors (columns) by falling eigenvalue, relative residuals, and passes over the data."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal basis of what ``block`` adds to the spans of ``against``."""
    for _ in range(2):
        for other in against:
            block = block - other @ (other.T @ block)
    length = np.linalg.norm(block, axis=0)
    block = block[:, length > 0] / length[length > 0]
    if not block.shape[1]:
        return block
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    u = u[:, s > 1e-10 * s[0]]
    for other in against:
        u = u - other @ (other.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def minres(multiply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solution of a symmetric system for each column of ``right``; a step is one product for all columns.

    Ends when every residual is below ``enough`` of its column, or after ``steps``.
    """
    start = np.linalg.norm(right, axis=0)
    beta = np.zeros_like(start)
    live = start > 0
    v = right / np.where(live, start, 1)
    v_before, x = np.zeros_like(v), np.zeros_like(v)
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    eta, c, s, c_before, s_before = start.copy(), np.ones_like(start), np.zeros_like(start), np.ones_like(start), np.zeros_like(start)
    for _ in range(steps):
        if not live.any():
            break
        p = multiply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_before
        further = np.linalg.norm(p, axis=0)
        turned = c * alpha - c_before * s * beta
        diagonal = np.hypot(turned, further)
        live &= diagonal > 0
        safe = np.where(live, diagonal, 1)
        above, far = s * alpha + c_before * c * beta, s_before * beta
        w, w_before = (v - far * w_before - above * w) / safe, w
        c_before, s_before = c, s
        c, s = turned / safe, further / safe
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live &= (np.abs(eta) > enough * start) & (further > 0)
        v_before, v, beta = v, p / np.where(further > 0, further, 1), further
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], length: int, wanted: int) -> Components:
    """The ``wanted`` largest eigenpairs of a symmetric matrix that is only known by its products with blocks."""
    wanted = min(wanted, length)
    passes = 0

    def multiply(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(block)

    locked, locked_values, locked_residuals = np.zeros((length, 0)), np.zeros(0), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(13).normal(size=(length, min(length, wanted + SPARE))))
    image = multiply(basis)
    best, stalled = np.inf, 0
    for number in range(ROUNDS):
        small = basis.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        norm = max(np.abs(ritz).max(initial=0), locked_values.max(initial=0))
        needed = min(wanted - len(locked_values), len(ritz))
        residual = image[:, :needed] - basis[:, :needed] * ritz[:needed]
        residual = residual - locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0) / (norm or 1)
        limit = ROUNDING * np.finfo(float).eps * np.sqrt(length)
        worst = size.max(initial=0)
        best, stalled = (worst, 0) if worst < best / 2 else (best, stalled + 1)
        if stalled >= 3 and worst <= STALLED:
            limit = worst
        done = int(np.argmin(np.append(size <= limit, False)))
        locked = np.column_stack([locked, basis[:, :done]])
        locked_values = np.append(locked_values, ritz[:done])
        locked_residuals = np.append(locked_residuals, size[:done])
        basis, image, ritz, residual = basis[:, done:], image[:, done:], ritz[done:], residual[:, done:]
        if done:
            best, stalled = np.inf, 0
        if len(locked_values) >= wanted:
            # A larger value that showed up late takes the place of a smaller one.
            if not len(ritz) or ritz[0] <= locked_values.min() + limit * norm:
                break
            again = np.argsort(-locked_values)
            locked, locked_values, locked_residuals = locked[:, again], locked_values[again], locked_residuals[again]
            basis = np.column_stack([locked[:, -1:], basis])
            image = np.column_stack([locked[:, -1:] * locked_values[-1], image])
            locked, locked_values, locked_residuals = locked[:, :-1], locked_values[:-1], locked_residuals[:-1]
            continue
        target = basis[:, : residual.shape[1]]
        wall = np.column_stack([locked, target])

        def projected(block: np.ndarray, wall=wall, shift=ritz[: residual.shape[1]]) -> np.ndarray:
            block = block - wall @ (wall.T @ block)
            block = multiply(block) - shift * block
            return block - wall @ (wall.T @ block)

        rest = residual - wall @ (wall.T @ residual)
        # The exact Ritz vectors of the whole space need no correction, only a fresh product.
        whole = locked.shape[1] + basis.shape[1] >= length
        added = np.zeros((length, 0)) if whole else minres(projected, -rest, STEPS, max(0.5 ** (number + 2), 1e-3))
        if not whole and locked.shape[1] + basis.shape[1] + added.shape[1] > WIDTH * (wanted + SPARE):
            kept = wanted - len(locked_values) + SPARE
            basis, image = basis[:, :kept], image[:, :kept]
        added = _orthonormal(added, locked, basis)
        if added.shape[1]:
            basis, image = np.column_stack([basis, added]), np.column_stack([image, multiply(added)])
        else:
            basis = _orthonormal(basis, locked)
            image = multiply(basis)
    else:
        raise ArithmeticError(f"no convergence in {ROUNDS} rounds, relative residual {worst}")
    order = np.argsort(-locked_values, kind="stable")
    return Components(locked_values[order], locked[:, order], locked_residuals[order], passes)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` of the rows that take part."""
    cast = F.col("embedding").cast("array<double>")
    rows = vectors.filter(F.col("embedding").isNotNull()).select("vec_id", cast.alias("c"))
    rows = rows.filter(F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)))
    rows = rows.select("vec_id", F.transform("c", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").limit(1).select(F.col("length").alias("_length"))
    return rows.join(F.broadcast(usual), F.size("x") == F.col("_length")).drop("_length")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) - SHIFT


class FitList:
    """The stored distinct vectors: their number, exact sums, and sums over their centred rows."""

    def __init__(self, table: DataFrame, number: int) -> None:
        self.table, self.n = table, number
        sums = self._total(lambda rows: rows.sum(axis=0), "long")
        self.sums = sums.astype(np.int64)

    def _total(self, part: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray:
        """Sum over all tasks of ``part(rows)``, added up by place on the executors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    found = part(_matrix(batch.column(0)))
                    total = found if total is None else total + found
            if total is not None:
                flat = total.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "part"])

        rows = self.table.mapInArrow(run, f"place long, part {kind}").groupBy("place").agg(F.sum("part").alias("part"))
        found = rows.toArrow()
        order = np.argsort(found.column("place").to_numpy())
        return found.column("part").to_numpy()[order]

    def centred_total(self, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        n, sums = self.n, self.sums
        return self._total(lambda rows: part((n * rows - sums) / n), "double")

    def covariance_times(self, block: np.ndarray) -> np.ndarray:
        shared = self.table.sparkSession.sparkContext.broadcast(block)
        try:
            return self.centred_total(lambda c: c.T @ (c @ shared.value)).reshape(block.shape) / self.n
        finally:
            shared.unpersist()


def whiten(vectors: DataFrame, components: int = COMPONENTS, work: Workspace | None = None) -> DataFrame:
    """Rows of ``vec_id`` and ``component`` (from 1): ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    ``n`` is the number of distinct vectors, ``deviation`` the exact sum of (n * x - S)^2, ``whitened`` the centred vector on the
    component over its standard deviation, ``explained`` the component's share of the variance, ``identity_error`` the largest
    difference of the whitened distinct vectors' covariance from the identity.
    """
    spark = vectors.sparkSession
    work = work or Workspace(spark)
    name = f"whitening-{uuid.uuid4().hex[:8]}"
    kind = vectors.schema["vec_id"].dataType.simpleString()
    fields = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    points, number = work.write(f"{name}-points", whole_vectors(vectors))
    distinct, n = work.write(f"{name}-fit", points.select("x").distinct())
    length = len(distinct.first()["x"]) if n else 0
    if not length:
        return spark.createDataFrame([], fields)
    fit = FitList(distinct, n)
    trace = float(fit.centred_total(lambda c: (c * c).sum(axis=0)).sum() / n)
    found = jacobi_davidson(fit.covariance_times, length, components)
    real = found.values > ROUNDING * np.finfo(float).eps * length * found.values.max(initial=0)
    values, directions = found.values[real], found.vectors[:, real] / np.sqrt(found.values[real])
    if not len(values):
        return spark.createDataFrame([], fields)
    k = len(values)
    shared = spark.sparkContext.broadcast((n, fit.sums, directions))
    mean = fit.centred_total(lambda c: (c @ shared.value[2]).sum(axis=0)) / n

    def moments(c: np.ndarray) -> np.ndarray:
        white = c @ shared.value[2] - mean
        return white.T @ white

    error = float(np.abs(fit.centred_total(moments).reshape(k, k) / n - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, directions = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = n * _matrix(batch.column(1)) - sums
            fits = (whole.astype(float) ** 2).sum(axis=1) < 9.2e18
            deviation = pa.array((whole * whole).sum(axis=1), pa.int64(), mask=~fits)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), k))
            columns = [batch.column(0).take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows))]
            columns += [pa.array(np.full(len(rows), n)), deviation.take(rows), pa.array(((whole / n) @ directions).ravel())]
            columns += [pa.array(np.tile(values / trace, batch.num_rows)), pa.array(np.full(len(rows), error))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in fields.split(", ")])

    return points.mapInArrow(project, fields)
