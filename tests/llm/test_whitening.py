import math
import random

import numpy as np
import pytest

from docflow.llm import whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, x string, place int, id long"


def plain(rows, wanted=16):
    """Per (id, component): n, deviation, |whitened|, explained, by numpy's symmetric solver and Python integers."""
    sound = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
             if v and all(c is not None and math.isfinite(c) for c in v)]
    if not sound:
        return {}
    sizes = [len(v) for _, v in sound]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    sound = [r for r in sound if len(r[1]) == size]
    fit = sorted({tuple(v) for _, v in sound})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda v: np.array([(n * a - s) / n for a, s in zip(v, sums)])
    X = np.array([centred(v) for v in fit])
    V = X.T @ X / n
    e, U = np.linalg.eigh(V)
    order = [k for k in np.argsort(-e)[:wanted] if e[k] > 1e-9 * max(e.max(), 1e-300)]
    out = []
    for i, v in sound:
        far = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for c, k in enumerate(order, 1):
            out.append((i, c, n, far, abs(centred(v) @ U[:, k]) / math.sqrt(e[k]), e[k] / np.trace(V)))
    return sorted(out, key=str)


def run(spark, rows, **kwargs):
    table = spark.createDataFrame([(i, v, "x", 1, 5) for i, v in rows], SCHEMA)
    got = whitening.whiten(table, **kwargs).collect()
    assert all(r["identity_error"] < 1e-9 for r in got)
    return sorted([(r["vec_id"], r["component"], r["n"], int(r["deviation"]), abs(r["whitened"]), r["explained"]) for r in got], key=str)


def agree(got, want):
    got, want = (sorted(x, key=lambda r: (r[0] is None, r[:4])) for x in (got, want))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in got], [r[4] for r in want], rtol=1e-8, atol=1e-8)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(rng.normal(size=(n, d)) * np.linspace(1, 3, d))]


@pytest.mark.parametrize("n,d", [(300, 24), (40, 64), (50, 5), (3, 4)])
def test_against_a_dense_solver(spark, n, d):
    rows = vectors(n, d)
    agree(run(spark, rows), plain(rows))


def test_edges(spark):
    rows = vectors(60, 6)
    rows += rows[:5] + [(None, rows[7][1]), (7, rows[8][1])] + [(100 + k, rows[3][1]) for k in range(200)]
    rows += [(900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [1.0] * 5 + [float("nan")]),
             (904, [float("inf")] * 6), (905, [1.0] * 7), (906, [1.0, 2.0])]
    random.Random(1).shuffle(rows)
    got = run(spark, rows)
    agree(got, plain(rows))
    assert not {r[0] for r in got} & set(range(900, 910))


def test_nothing_to_fit(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0, 2.0])] * 3) == []
    assert run(spark, [(1, None)]) == []


def test_far_values_stay_exact(spark):
    rows = [(k, [float(np.float32(c * 1e9)) for c in v]) for k, v in vectors(30, 4)]
    agree(run(spark, rows), plain(rows))


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agree(run(spark, rows), plain(rows))


def spectrum(values, seed=3):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 5.0, 5.0, 1.0, 0.5, 0.1], [1.0] * 9, list(np.linspace(1, 2, 40)), [1 + 1e-9 * k for k in range(8)] + [0.1] * 4,
    list(np.geomspace(1e-6, 1e6, 30)), [3.0, 2.0, 0.0, 0.0]], ids=["equal", "one", "even", "cluster", "wide", "singular"])
def test_intervals_and_pairs(spark, values):
    matrix = spectrum(values)
    matrix = (matrix + matrix.T) / 2
    tri = whitening.tridiagonal(matrix)
    for shift in np.linspace(-1, max(values) + 1, 23):
        assert whitening.count_above(tri, shift) == sum(v > shift for v in np.linalg.eigvalsh(matrix))
    got, vectors = whitening.components(spark, matrix, 6)
    want = np.sort([v for v in values if v > 1e-9 * max(values)])[::-1][:6]
    assert np.allclose(got, want, rtol=1e-7, atol=1e-12 * max(values))
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-11 * max(values)


def test_a_wrong_inertia_count_is_an_error():
    with pytest.raises(ArithmeticError):
        whitening.feast(spectrum([3.0, 2.0, 1.0]), 1.5, 3.5, 3)
