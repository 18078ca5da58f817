"""Jacobi-Davidson against a dense solver, whitening against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopwise.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("kind", ["spread", "close", "decaying", "repeated", "low rank", "zero"])
@pytest.mark.parametrize("length", [3, 40, 150])
def test_eigenpairs(kind, length):
    draw = np.random.default_rng(length)
    turn = np.linalg.qr(draw.normal(size=(length, length)))[0]
    at = np.arange(length)
    values = {
        "spread": draw.uniform(1, 100, length), "close": 1 + 0.05 * draw.random(length), "decaying": np.exp(-at / 4.0),
        "repeated": np.where(at < length // 4, 3.0, 1.0), "low rank": np.where(at < 2, 1.0, 0.0), "zero": np.zeros(length),
    }[kind]
    matrix = (turn * values) @ turn.T
    found = whitening.jacobi_davidson(lambda block: matrix @ block, length, 16)
    k = min(16, length)
    assert np.allclose(found.values, np.sort(values)[::-1][:k], atol=1e-13 * max(1, values.max()))
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-12
    residual = np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0)
    assert residual.max() <= 1e-12 * max(1, values.max()) and found.residuals.max(initial=0) < 1e-11


def test_minres_solves():
    draw = np.random.default_rng(1)
    half = draw.normal(size=(12, 12))
    matrix = half + half.T
    right = draw.normal(size=(12, 4))
    right[:, 2] = 0
    assert np.allclose(matrix @ whitening.minres(lambda b: matrix @ b, right, 14, 1e-14), right, atol=1e-6)


def plain_whitening(rows, components=16):
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = {k: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for k, v in kept}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    return x, n, s, values[::-1][:components], vectors[:, ::-1][:, :components], np.trace(covariance)


def test_whitening(spark):
    draw = np.random.default_rng(6)
    rows = [(k, [float(np.float32(c)) for c in draw.normal(size=20) * np.linspace(1, 3, 20)]) for k in range(400)]
    rows += [(1000 + k, rows[k][1]) for k in range(30)] + [(2000, None), (2001, [None] * 20), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("x")).repartition(5)).toPandas()
    x, n, s, values, vectors, trace = plain_whitening(rows)
    assert n == 400 and set(found.vec_id) == set(x) and len(found) == 16 * len(x)
    assert set(found.n) == {400} and found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10
    wide = found.pivot(index="vec_id", columns="component", values="whitened")
    deviation = found.drop_duplicates("vec_id").set_index("vec_id").deviation
    mine = np.array([wide.loc[k] for k in x])
    other = np.array([(n * np.array(v) - s) / n @ vectors / np.sqrt(values) for v in x.values()])
    sign = np.sign((mine * other).sum(axis=0))
    assert np.allclose(mine, other * sign, atol=1e-9)
    assert all(deviation[k] == sum((n * a - b) ** 2 for a, b in zip(v, s.tolist(), strict=True)) for k, v in x.items())
    explained = found.drop_duplicates("component").sort_values("component").explained
    assert np.allclose(explained, values / trace, rtol=1e-10)


def test_odd_vectors(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    rows = [(1, [1.0, 2.0]), (None, [3.0, 2.0]), (3, [1.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (5, [1e30, 0.0])]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.vec_id, r.component, r.n, round(abs(r.whitened), 9)) for r in found), key=repr) == sorted(
        [(1, 1, 2, 1.0), (None, 1, 2, 1.0), (4, 1, 2, 1.0), (4, 1, 2, 1.0)], key=repr
    )
