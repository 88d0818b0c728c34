import math

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import exact_spectrum as X
from plumbline.llm.queries import op12_whitening
from plumbline.llm.vectors import matrices, packed, unpacked, whole
from plumbline.llm.whitening import _gram, fit, whitened_rows


def polynomial_of(matrix):
    """Characteristic polynomial by plain division-free traces."""
    size = len(matrix)
    a, m, c = np.array(matrix, object), np.zeros((size, size), object), [0] * size + [1]
    for k in range(1, size + 1):
        m = a @ m + c[size - k + 1] * np.array([[int(i == j) for j in range(size)] for i in range(size)], object)
        c[size - k] = -int(np.trace(a @ m)) // k
    return c


@pytest.mark.parametrize("seed", range(8))
def test_polynomial_of_random_matrices(spark, seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 9))
    b = rng.integers(-50, 50, (size, max(1, size - seed % 3))).astype(object)
    matrix = (b @ b.T).tolist()
    whole_, simple = X.polynomial(spark, matrix)
    assert whole_ == polynomial_of(matrix)
    assert X.divided(whole_, simple)[1] == [0] * (len(simple) - 1)


def test_roots_with_repetition():
    coefficients = [1]
    for root in (3, 3, 3, 7, 10**6, 10**6 + 1, 0):  # product of (x - root)
        coefficients = [a - root * b for a, b in zip([0, *coefficients], [*coefficients, 0])]
    simple = [1]
    for root in (3, 7, 10**6, 10**6 + 1, 0):
        simple = [a - root * b for a, b in zip([0, *simple], [*simple, 0])]
    assert [X.roots_above(coefficients, k) for k in (-1, 0, 2, 3, 6, 7, 10**6, 10**6 + 1)] == [7, 6, 6, 3, 3, 2, 1, 0]
    roots = X.isolated(coefficients, simple, 6)
    assert [root.times for root in roots] == [1, 1, 1, 3]
    assert [X.refined(simple, root, root.bits + 20) / 2 ** (root.bits + 20) for root in roots] == [10**6 + 1, 10**6, 7, 3]
    assert len(X.isolated(coefficients, simple, 1)) == 2


def reference(vectors, count):
    """Whitening by numpy from the distinct whole vectors, centred before multiplying."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    centre = distinct.sum(axis=0) / len(distinct)
    values, components = np.linalg.eigh((distinct - centre).T @ (distinct - centre) / len(distinct))
    order = np.argsort(values)[::-1][:count]
    n, sums = len(distinct), distinct.sum(axis=0)
    deviation = [int(sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums))) for row in x]
    return n, deviation, (x - centre) @ components[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_query_equals_numpy(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, whitened, explained = reference([row["embedding"] for row in given], 16)
    rows = op12_whitening(spark, sf_dir).collect()
    assert len(rows) == 16 * len(given)
    at = {row["vec_id"]: k for k, row in enumerate(given)}
    got = np.empty_like(whitened)
    for row in rows:
        assert row["n"] == n and row["deviation"] == deviation[at[row["vec_id"]]] and row["identity_error"] < 1e-12
        assert math.isclose(row["explained"], explained[row["component"] - 1], rel_tol=1e-9)
        got[at[row["vec_id"]], row["component"] - 1] = row["whitened"]
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.allclose(got, whitened * signs, atol=1e-8)
    # The whitened vectors themselves, one of each distinct one, have covariance one.
    _, first = np.unique(np.floor(64 * np.array([row["embedding"] for row in given], float)), axis=0, return_index=True)
    assert np.allclose(got[first].T @ got[first] / n, np.eye(16), atol=1e-9)


def frame(spark, vectors, kind="double"):
    return spark.createDataFrame([(k, v, "clash", "clash") for k, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>, component string, n string").repartition(3)


def test_repeated_close_and_missing_eigenvalues(spark):
    """One-hot vectors have one eigenvalue d - 1 times; a constant and a doubled dimension add none."""
    d = 5
    vectors = [[float(i == j) * 4 for j in range(d)] + [7.0, float(i == 0) * 4] for i in range(d)] * 3
    fitted = fit(frame(spark, vectors))
    assert fitted.n == d and len(fitted.components) == d - 1
    assert fitted.identity_error < 1e-12
    x = np.unique(np.floor(64 * np.array(vectors)), axis=0)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1][: d - 1]
    assert np.allclose(fitted.explained, values / np.trace(np.cov(x.T, bias=True)), rtol=1e-9)
    assert np.allclose(np.array(fitted.components) @ np.array(fitted.components).T, np.eye(d - 1), atol=1e-15)
    # Eigenvalues apart by 1e-9 of themselves: n = 4, diagonal scatter.
    close = [[1e6, 0.0], [-1e6, 0.0], [0.0, 1e6 + 1 / 64], [0.0, -1e6 - 1 / 64]]
    fitted = fit(frame(spark, close))
    assert np.allclose(np.abs(fitted.components), [[0, 1], [1, 0]], atol=1e-15)


def test_large_offsets_keep_their_digits(spark):
    rng = np.random.default_rng(5)
    small = rng.normal(size=(40, 3))
    near, far = fit(frame(spark, (np.floor(64 * small) / 64).tolist())), fit(frame(spark, (np.floor(64 * small) / 64 + 2.0**34).tolist()))
    assert np.allclose(near.columns, far.columns, rtol=1e-12) and near.explained == far.explained
    rows = [{(r["vec_id"]): r for r in f.apply(frame(spark, v.tolist())).collect()} for f, v in ((near, np.floor(64 * small) / 64), (far, np.floor(64 * small) / 64 + 2.0**34))]
    for k in rows[0]:
        assert rows[0][k]["deviation"] == rows[1][k]["deviation"]
        assert np.allclose(rows[0][k]["whitened"], rows[1][k]["whitened"], rtol=1e-9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.0, 5.0], [4.0, 4.5], [1.0, 2.0]]
    odd = [None, [], [1.0], [1.0, None], [nan, 1.0], [inf, 1.0], [-inf, 0.0], [1.0, 2.0, 3.0]]
    df = frame(spark, good + odd)
    df = df.union(df.limit(1)).union(spark.createDataFrame([(None, [9.0, 9.0], "x", "y")], df.schema))
    rows = whitened_rows(df).collect()
    assert rows[0]["n"] == 4
    assert {row["vec_id"] for row in rows} == {0, 1, 2, 3, None}
    assert len(rows) == 2 * 6  # one row comes twice
    assert whitened_rows(frame(spark, [])).collect() == []
    assert whitened_rows(frame(spark, [[1.0, 2.0]] * 4)).collect() == []
    assert whitened_rows(frame(spark, [None, [nan]])).collect() == []
    huge = whitened_rows(frame(spark, [[1e300, 1.0], [-1e300, 2.0], [0.0, 5.0]])).collect()
    assert len(huge) == 6 and all(row["identity_error"] < 1e-9 and math.isfinite(row["whitened"]) for row in huge)
    assert {row["deviation"] is None for row in huge if row["vec_id"] < 2} == {True}


def test_packed_vectors_return():
    rows = np.array([[1, -2], [-128, 127], [128, 0], [2**40, -(2**40)], [-(2**62), 2**62], [0, 0]], np.int64)
    arrays = packed(rows)
    assert sorted(map(tuple, np.vstack([m for a in arrays for m in unpacked(a, 2)]).tolist())) == sorted(map(tuple, rows.tolist()))
    assert [len(a[0].as_py()) for a in arrays] == [3, 5, 17]
    big = np.array([[2**61, -3], [-(2**62), 2**21], [5, 1]], np.int64)
    assert (_gram(big) == big.astype(object).T @ big.astype(object)).all()
    given = pa.array([[1.0, 2.0], None, [3.0, None], [float("inf"), 1.0], [], [4.0, 5.0]], pa.list_(pa.float32()))
    assert [(at.tolist(), m.tolist()) for at, m in matrices(given.slice(0))] == [([4], [[]]), ([0, 5], [[1.0, 2.0], [4.0, 5.0]])]
    assert [at.tolist() for at, _ in matrices(given.slice(4))] == [[0], [1]]
    assert whole(np.array([[1e308, -0.01]]), 64).tolist() == [[2**62, -1]]
