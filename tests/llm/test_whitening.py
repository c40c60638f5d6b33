import math

import numpy as np
import pytest

from ledgerlens.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, id string, vector string, component string"


def table(spark, vectors, parts=3):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "clash", "clash", "clash") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(vectors, most=32):
    """n, covariance, and {id: (deviation, centred vector)} by plain integers and NumPy's own solver."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n = len(good)
    sums = [sum(x[d] for _, x in good) for d in range(len(good[0][1]))]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in good])
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in good]
    return n, [i for i, _ in good], centred, deviation, centred.T @ centred / n


def check(spark, vectors, most=32, parts=3):
    n, ids, centred, deviation, covariance = brute(vectors)
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    k = int((values[:most] > 1e-9 * values[0]).sum())
    rows = w.whiten(table(spark, vectors, parts), most=most).collect()
    assert len(rows) == n * k
    assert {r["n"] for r in rows} == {n} and {r["component"] for r in rows} == set(range(1, k + 1))
    assert sorted(r["deviation"] for r in rows) == sorted(d for d in deviation for _ in range(k))
    assert all(r["identity_error"] < 1e-8 for r in rows)
    share = {r["component"]: r["explained"] for r in rows}
    np.testing.assert_allclose([share[c + 1] for c in range(k)], values[:k] / np.trace(covariance), rtol=1e-9)
    model = w.fit(table(spark, vectors), most=most)
    np.testing.assert_allclose(covariance @ model.components, model.components * model.values, atol=1e-9 * values[0])
    made = {}
    for r in rows:
        made.setdefault(r["component"], []).append((str(r["id"]), r["whitened"]))
    for c in range(k):
        want = centred @ model.components[:, c] / np.sqrt(model.values[c])
        np.testing.assert_allclose(*[np.array([v for _, v in sorted(pairs)]) for pairs in (
            made[c + 1], list(zip(map(str, ids), want)))], atol=1e-9)
    return model, values, basis


def test_against_numpy(spark):
    draw = np.random.default_rng(3)
    vectors = list(enumerate((draw.normal(size=(400, 40)) * np.geomspace(2, 0.1, 40) + 0.3).tolist()))
    model, values, basis = check(spark, vectors)
    assert np.allclose(np.abs(np.sum(model.components * basis[:, :32], axis=0)), 1, atol=1e-8)


def test_odd_vectors(spark):
    """Nulls, null entries, NaN, infinities, other lengths, empty vectors, repeated rows and null ids."""
    draw = np.random.default_rng(4)
    good = [(i if i % 10 else None, v) for i, v in enumerate(draw.normal(size=(60, 5)).tolist())]
    good += good[:7]
    odd = [(900, None), (901, [1.0, None, 0, 0, 0]), (902, [math.nan, 0, 0, 0, 0]), (903, [math.inf, 0, 0, 0, 0]), (904, [0, 0, -math.inf, 0, 0])]
    check(spark, good + odd)
    other = [(905, [1.0, 2.0]), (906, []), (907, [3e38, 0, 0, 0, 0])]
    ids = {r["id"] for r in w.whiten(table(spark, good + odd + other)).collect()}
    assert ids == {i for i, _ in good}


def test_equal_eigenvalues(spark):
    """Signed unit vectors have a covariance of equal eigenvalues; any basis will do."""
    vectors = [(i, np.where(np.arange(12) == i % 12, 1.0 if i < 12 else -1.0, 0).tolist()) for i in range(24)]
    check(spark, vectors, most=8)


def test_fewer_vectors_than_dimensions(spark):
    check(spark, list(enumerate(np.random.default_rng(5).normal(size=(6, 20)).tolist())))


def test_a_third_of_equal_rows(spark):
    draw = np.random.default_rng(6)
    check(spark, [(None, [0.5, -0.25, 1.0])] * 200 + list(enumerate(draw.normal(size=(400, 3)).tolist())), parts=7)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, [0.5, 1.0])], [(i, [2.0, 3.0]) for i in range(9)]])
def test_nothing_to_whiten(spark, vectors):
    assert w.whiten(table(spark, vectors)).collect() == []


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 40], [0], [3]])
    sums = (int(x.sum()),)
    assert w._deviation(x, 3, sums).to_pylist() == [None, None, None]
    assert w._deviation(x, 3, sums).type == "int64"
    far = np.array([[1 << 31, 0], [0, 0]])
    exact = [sum((2 * int(a) - s) ** 2 for a, s in zip(row, (1 << 31, 0))) for row in far]
    assert w._deviation(far, 2, (1 << 31, 0)).to_pylist() == exact


@pytest.mark.parametrize("values", [
    np.ones(30), np.r_[np.full(10, 5.0), np.full(10, 3.0), np.zeros(10)], 1 + np.arange(30) * 1e-13, np.geomspace(1, 1e-12, 30)])
def test_eigenvectors_of_clusters(values):
    turn, _ = np.linalg.qr(np.random.default_rng(7).normal(size=(30, 30)))
    for matrix in (np.diag(values), (turn * values) @ turn.T):
        matrix = (matrix + matrix.T) / 2
        got, basis = w.leading(matrix, 12)
        np.testing.assert_allclose(got, np.sort(values)[::-1][:12], atol=1e-13)
        np.testing.assert_allclose(basis.T @ basis, np.eye(12), atol=1e-12)
        np.testing.assert_allclose(matrix @ basis, basis * got, atol=1e-13)


def test_sturm_counts():
    draw = np.random.default_rng(8)
    diagonal, side = draw.normal(size=9), np.r_[draw.normal(size=4), 0.0, draw.normal(size=3)]
    full = np.diag(diagonal) + np.diag(side, 1) + np.diag(side, -1)
    shifts = np.linspace(-4, 4, 101)
    assert w.below(diagonal, side, shifts).tolist() == [(np.linalg.eigvalsh(full) < s).sum() for s in shifts]
