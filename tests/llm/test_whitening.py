"""Whitening against plain numpy, and the eigenvectors against another method."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from abacist.llm import queries, whitening
from abacist.llm.spectral import leading_components, polar_factor

VECTORS = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("kind", ["spread", "ties", "steep", "flat", "low", "one"])
def test_leading_components(kind):
    rng = np.random.default_rng(7)
    size = 1 if kind == "one" else 24
    values = {
        "spread": np.linspace(1, 3, size),
        "ties": np.repeat([5.0, 5.0, 2.0, 1.0], 6)[:size],
        "steep": 10.0 ** -np.arange(size),
        "flat": np.full(size, 2.0),
        "low": np.concatenate(([3.0, 1.0], np.zeros(size - 2))) if size > 1 else np.ones(1),
        "one": np.ones(1),
    }[kind]
    basis, _ = np.linalg.qr(rng.normal(size=(size, size)))
    matrix = basis * values @ basis.T
    found, vectors = leading_components(matrix, 4)
    assert np.allclose(found, np.sort(values)[::-1][:4], atol=1e-13 * values.max())
    assert np.allclose(vectors @ vectors.T, np.eye(len(vectors)), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=1e-12 * values.max())


def test_polar_factor():
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(20, 20))
    matrix += matrix.T
    values, vectors = np.linalg.eigh(matrix)
    assert np.allclose(polar_factor(matrix), vectors * np.sign(values) @ vectors.T, atol=1e-12)


def brute(rows, components=4):
    kept = [(i, [int(np.floor(np.float64(c) * 256)) for c in v]) for i, v in rows]
    distinct = sorted({tuple(x) for _, x in kept})
    n, size = len(distinct), len(distinct[0])
    sums = [sum(column) for column in zip(*distinct)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in distinct])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    found = {}
    for i, x in kept:
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        off = np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums)])
        for number, k in enumerate(order, 1):
            found.setdefault((i, number), []).append((n, deviation, off @ vectors[:, k] / np.sqrt(values[k]), values[k] / values.sum()))
    return found


def test_whitened_vectors(spark):
    rng = np.random.default_rng(11)
    values = (rng.normal(size=(300, 12)) * np.linspace(0.2, 2, 12)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    rows += [(i + 500, values[5].tolist()) for i in range(200)]  # copies count once in the fit
    rows += [(7, values[9].tolist())]
    random.Random(2).shuffle(rows)
    wanted = brute(rows)
    table = spark.createDataFrame(rows, VECTORS).withColumns({"x": F.lit(1), "n": F.lit("z"), "component": F.lit(0)})
    found = whitening.whitened_vectors(table).collect()
    assert len(found) == 4 * len(rows)
    signs = {}
    for row in found:
        options = wanted[row.vec_id, row.component]
        sign = signs.setdefault(row.component, np.sign(row.whitened * options[0][2]) if len(options) == 1 else None)
        if sign is None:
            del signs[row.component]
            continue
        assert any(row.n == n and row.deviation == d and abs(row.whitened - sign * w) < 1e-9 for n, d, w, _ in options)
        assert abs(row.explained - options[0][3]) < 1e-12 and row.identity_error < 1e-10
    assert set(signs) == {1, 2, 3, 4}


def test_odd_vectors(spark):
    bad = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [float("inf"), 1.0]), (6, [1.0, 2.0, 3.0])]
    rows = [*bad, (None, [1.0, 0.0]), (8, [-1.0, 0.0]), (8, [-1.0, 0.0]), (9, [0.0, -0.0])]
    found = whitening.whitened_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (8, 1), (8, 1), (8, 2), (8, 2), (9, 1), (9, 2)]
    assert {r.n for r in found} == {3} and all(r.whitened is None for r in found if r.component == 2)
    assert all(abs(abs(r.whitened) - (0 if r.vec_id == 9 else 1.5**0.5)) < 1e-12 for r in found if r.component == 1)
    alone = whitening.whitened_vectors(spark.createDataFrame([(1, [2.0, 3.0])], VECTORS)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in alone] == [(1, 1, 0, None, None), (2, 1, 0, None, None)]
    assert whitening.whitened_vectors(spark.createDataFrame(bad[:5], VECTORS)).count() == 0
    large = whitening.whitened_vectors(spark.createDataFrame([(1, [1e12, 0.0]), (2, [-1e12, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert {int(r.deviation) for r in large} == {(2 * 256 * 10**12) ** 2}


def test_query(spark, sf_dir):
    found = queries.op11_whitening(spark, sf_dir)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, sf_dir, "embeddings").collect()]
    wanted, signs = brute(rows), {}
    found = found.collect()
    assert len(found) == 4 * len(rows)
    for row in found:
        n, deviation, value, explained = wanted[row.vec_id, row.component][0]
        sign = signs.setdefault(row.component, np.sign(row.whitened * value))
        assert (row.n, row.deviation) == (n, deviation)
        assert abs(row.whitened - sign * value) < 1e-6 and abs(row.explained / explained - 1) < 1e-6 and row.identity_error < 1e-9
