import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm.whitening import components, fit_whitening, polar, whiten

SCHEMA = "vec_id long, embedding array<float>, n string, whitened string, x int"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [2.0, 1.0],
        [0.0, 1.0, 2.0],  # the mean is an eigenvalue
        [1.0] * 6,
        [5.0, 5.0, 5.0, 1.0, 1.0],
        [1e6, 1.0, 1e-3, 1e-9, 0.0],
        [1e-200, 3e-200, 2e-200],
        [0.0] * 4,
        list(np.linspace(1, 2, 64)),
        list(1.5 ** -np.arange(40.0)),
        [1 + 1e-9, 1.0, 1 - 1e-9, 0.5],
        [*([3.0] * 20), *([3.0 + 1e-12] * 5), 7.0],
    ],
)
def test_components_against_a_symmetric_solver(values):
    a = symmetric(values, len(values))
    a = (a + a.T) / 2
    found, vectors = components(a)
    scale = np.linalg.norm(a) or 1.0
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * scale * len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12
    assert np.linalg.norm(a @ vectors - vectors * found) <= 1e-12 * scale * len(values)


def test_polar_factor_has_the_signs_of_the_eigenvalues():
    values = np.array([3.0, 1e-7, -1e-7, -2.0, 0.4])
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((5, 5)))
    u = polar(q @ np.diag(values) @ q.T)
    assert np.abs(u - q @ np.diag(np.sign(values)) @ q.T).max() < 1e-7


def brute(rows, keep=4):
    usable = []
    for key, v, *_ in rows:
        if v is not None and all(e is not None and math.isfinite(e) for e in v):
            usable.append((key, tuple(math.floor(256 * float(np.float32(e))) for e in v)))
    fit = sorted({x for _, x in usable})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for key, x in usable:
        off = np.array(x, float) - np.array([s / n for s in sums])
        for c in range(min(keep, width)):
            deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            out.append((key, c + 1, n, deviation, abs(off @ vectors[:, c]) / math.sqrt(values[c]), values[c] / values.sum()))
    return out


@pytest.mark.parametrize("seed, width, size", [(1, 8, 1.0), (2, 3, 1.0), (3, 6, 3e7)])
def test_against_brute_force(spark, seed, width, size):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, (d + 1) * size) for d in range(width)], "x", "y", 1) for i in range(200)]
    rows += [(500 + i, rows[0][1], "x", "y", 1) for i in range(120)]  # more than a third is one vector
    rows += [
        (None, [0.5] * width, "x", "y", 1),
        (None, None, "x", "y", 1),
        (7, [None] * width, "x", "y", 1),
        (8, [float("nan")] + [0.0] * (width - 1), None, None, None),
        (9, [float("-inf")] * width, "x", "y", 1),
        rows[3],
    ]
    got = whiten(spark.createDataFrame(rows, SCHEMA).repartition(5))
    found = sorted(
        ((r["vec_id"], r["component"], r["n"], int(r["deviation"]), abs(r["whitened"]), r["explained"]) for r in got.collect()),
        key=str,
    )
    expected = sorted(brute(rows), key=str)
    assert [f[:4] for f in found] == [e[:4] for e in expected]
    assert np.allclose([f[4:] for f in found], [e[4:] for e in expected], rtol=1e-9, atol=1e-9)
    errors = {r["identity_error"] for r in got.collect()}
    assert len(errors) == 1 and errors.pop() < 1e-9
    # One sign for all rows: whitened values of different rows have mean 0 over the distinct vectors.
    first = {r["vec_id"]: r["whitened"] for r in got.where("component = 1 AND vec_id < 200").collect()}
    alone = got.where("component = 1 AND vec_id IS NULL").first()["whitened"]
    assert abs(sum(first.values()) + alone) < 1e-8


def test_vectors_that_do_not_vary(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    got = whiten(same).orderBy("vec_id", "component").collect()
    assert [tuple(r) for r in got] == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = {(r["vec_id"], r["component"]): r for r in whiten(line).collect()}
    assert abs(got[1, 1]["whitened"]) == pytest.approx(1) and got[1, 1]["whitened"] == -got[2, 1]["whitened"]
    assert got[1, 1]["explained"] == 1 and got[1, 2]["whitened"] is None and got[1, 2]["explained"] == 0
    assert got[1, 1]["deviation"] == 256**2


def test_no_rows_and_errors(spark):
    schema = "vec_id long, embedding array<double>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0
    with pytest.raises(ValueError):
        whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))
    with pytest.raises(Exception, match="exact integers"):
        whiten(spark.createDataFrame([(1, [1e300])], schema))


def test_distinct_vectors_once(spark):
    rows = [(i, [float(i % 4), 0.001 * (i % 2)]) for i in range(400)]
    model, fit = fit_whitening(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7))
    assert model.n == 4 == fit.count() and model.sums == [6 * 256, 0]
    assert fit.where(F.size("x") != 2).count() == 0
