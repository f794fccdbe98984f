import math
import random

import numpy as np
import pytest

from zonalspark.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, component string"


def rows_of(vectors, first=0):
    return [(first + i, [float(x) for x in v], "c") for i, v in enumerate(vectors)]


def brute_force(vectors, k):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = ((n * x - sums) / n).astype(float)
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return deviation, centred @ basis / np.sqrt(values), values / np.trace(cov)


def test_symmetric_qr():
    rng = np.random.RandomState(1)
    for d in (1, 2, 3, 7, 40):
        a = rng.randn(d, d)
        for m in (a + a.T, a @ a.T, np.zeros((d, d)), np.eye(d) * 3, np.ones((d, d)), np.diag(np.arange(d, dtype=float)), (a @ a.T) * 1e-200, (a + a.T) * 1e150):
            values, basis = wh.symmetric_qr(m)
            scale = max(np.abs(m).max(), 1e-300)
            assert np.allclose(values / scale, np.linalg.eigvalsh(m)[::-1] / scale, atol=1e-12 * d)
            assert np.allclose(basis @ basis.T, np.eye(d), atol=1e-13 * d)
            assert np.allclose((basis / scale) @ m, values[:, None] * basis / scale, atol=1e-12 * d)
    with pytest.raises(ArithmeticError):
        wh.symmetric_qr(np.full((3, 3), np.nan))


def test_moments_merge_as_one_stream():
    rng = np.random.RandomState(2)
    x = (rng.randn(500, 6) * 30).astype(np.int64) + 1_000_000
    whole = wh.Moments(6)
    whole.add(x)
    parts = wh.Moments(6)
    for a in (0, 1, 1, 60, 400):
        part = wh.Moments(6)
        part.add(x[a : {0: 1, 1: 60, 60: 400, 400: 500}[a]] if a != 1 or parts.n == 1 else x[:0])
        parts.merge(wh.Moments.of(dict(zip(("part", "dims", "n", "sums", "mean", "products"), part.row(3, 6)))))
    assert parts.n == whole.n == 500 and parts.sums == whole.sums == x.sum(axis=0).tolist()
    exact = np.cov(x.T - 1_000_000.0, bias=True)
    assert np.allclose(whole.covariance(), exact, rtol=1e-10) and np.allclose(parts.covariance(), exact, rtol=1e-10)


def test_against_brute_force(spark):
    rng = np.random.RandomState(3)
    vectors = rng.randn(700, 8) @ rng.randn(8, 8) * 0.4
    odd = [(1000, None, "c"), (1001, [None] * 8, "c"), (1002, [float("nan")] + [0.0] * 7, None), (1003, [float("inf")] * 8, "c"), (1004, [], "c")]
    data = rows_of(vectors)
    df = spark.createDataFrame(data + odd + [(None, data[0][1], "c"), data[5]], SCHEMA).repartition(70)  # more than one level of merging
    fitted = [*vectors, vectors[0], vectors[5]]
    deviation, whitened, explained = brute_force(fitted, 5)
    got = {}
    for r in wh.whiten(df, components=5).collect():
        got.setdefault(r["vec_id"], []).append(r)
    assert set(got) == {*range(700), None}
    signs = np.sign([next(r["whitened"] for r in got[9] if r["component"] == k + 1) * whitened[9, k] for k in range(5)])
    for i, w in ((*enumerate(whitened[:700]), (None, whitened[0]))):
        rows = sorted(got[i], key=lambda r: r["component"])
        assert [r["component"] for r in rows] == [c for c in range(1, 6) for _ in range(2 if i == 5 else 1)]
        for r in rows:
            k = r["component"] - 1
            assert r["n"] == 702 and r["deviation"] == deviation[i if i is not None else 0]
            assert r["whitened"] == pytest.approx(signs[k] * w[k], rel=1e-7, abs=1e-8) and r["explained"] == pytest.approx(explained[k], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9 and r["identity_error"] == rows[0]["identity_error"]
    assert wh.report(df.limit(0)).count() == 0


def test_no_variance_and_other_lengths(spark):
    rng = random.Random(4)
    flat = rows_of([[0.5, 0.25, 1.0]] * 4)
    line = rows_of([[x := rng.random(), 2 * x] for _ in range(50)], 100)
    df = spark.createDataFrame(flat + line + rows_of([[3.0]], 900), SCHEMA)
    got = {}
    for r in wh.report(df).collect():
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    for i in range(4):
        assert set(got[i]) == {1, 2, 3} and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 and r["n"] == 4 for r in got[i].values())
    assert got[900][1]["n"] == 1 and got[900][1]["whitened"] is None
    assert all(set(got[i]) == {1, 2} and got[i][1]["whitened"] is not None for i in range(100, 150))
    assert np.var([got[i][1]["whitened"] for i in range(100, 150)]) == pytest.approx(1)


def test_deviations_beyond_a_long(spark):
    df = spark.createDataFrame(rows_of([[1e12, 0.0], [-1e12, 1.0], [0.0, 5.0], [1e300, 2.0]]), SCHEMA)
    got = {r["vec_id"]: r["deviation"] for r in wh.report(df).collect()}
    assert set(got.values()) == {None} and len(got) == 4
    small = spark.createDataFrame(rows_of([[1e7, 0.0], [-1e7, 1.0]]), SCHEMA)
    assert {r["deviation"] for r in wh.report(small).collect()} == {(2 * 64 * 10**7) ** 2 + 64**2}
