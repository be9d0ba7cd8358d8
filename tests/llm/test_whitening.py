"""Whitening against NumPy's eigenvectors of the exact covariance."""

from __future__ import annotations

import numpy as np
import pytest

from plantpulse.llm import whitening

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors: list[list[float]], components: int = 32):
    """x, n, S, eigenvalues by falling size, eigenvectors as columns."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(0)
    centred = np.array([[float(n * int(c) - int(s)) / n for c, s in zip(row, sums)] for row in x])
    values, right = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return centred, deviation, values[::-1][:components], right[:, ::-1][:, :components], values.sum()


def judged(df, vectors, components=32, rank=None):
    rows = df.toPandas()
    centred, deviation, values, right, trace = brute(vectors, components)
    rank = rank or min(components, len(values))
    assert len(rows) == len(vectors) * rank and set(rows["n"]) == {len(vectors)}
    wide = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    assert list(wide.columns) == list(range(1, rank + 1))
    first = rows[rows["component"] == 1].sort_values("vec_id")
    assert first["deviation"].tolist() == deviation
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iat[0] < 1e-9
    shares = rows.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(shares, values[:rank] / trace, rtol=1e-9)
    return wide.to_numpy(), centred @ right[:, :rank] / np.sqrt(values[:rank])


def same_up_to_sign(got, want):
    signs = np.sign((got * want).sum(0))
    assert np.allclose(got * signs, want, atol=1e-7)


def random_rows(n, d, seed=0):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, d)) @ np.diag(np.geomspace(5, 0.2, d)) @ r.standard_normal((d, d)) + 3).tolist()


@pytest.mark.parametrize("n, d", [(300, 6), (40, 40), (200, 1), (500, 48)])
def test_components_are_the_eigenvectors(rows, n, d):
    vectors = random_rows(n, d)
    rank = min(32, n - 1, d)
    got, want = judged(whitening.whiten_embeddings(rows(list(enumerate(vectors)), SCHEMA).repartition(5)), vectors, rank=rank)
    same_up_to_sign(got, want)


def test_equal_eigenvalues_are_all_found(rows):
    """Copies of plus and minus each unit vector: one eigenvalue of multiplicity 5, so every step has to begin anew."""
    vectors = [[s * 2.0 * (i == j) for j in range(5)] for i in range(5) for s in (1, -1)] * 3
    got, _ = judged(whitening.whiten_embeddings(rows(list(enumerate(vectors)), SCHEMA)), vectors)
    assert np.allclose(got.T @ got / len(vectors), np.eye(5), atol=1e-9)


def test_directions_without_variance_are_no_components(rows):
    base = random_rows(60, 3)
    vectors = [[a, b, 7.0, c, b] for a, b, c in base]
    got, want = judged(whitening.whiten_embeddings(rows(list(enumerate(vectors)), SCHEMA)), vectors, rank=3)
    same_up_to_sign(got, want)


def test_unusable_rows_lengths_and_columns(rows):
    good = random_rows(50, 4)
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0], [1.0, 2.0]]
    data = list(enumerate(good)) + [(1000 + i, v) for i, v in enumerate(bad)]
    plain = whitening.whiten_embeddings(rows(data, SCHEMA))
    got, want = judged(plain, good)
    same_up_to_sign(got, want)
    clashing = rows([(*r, 1.0, 2, "x") for r in data], SCHEMA + ", whitened double, n long, id string")
    again, _ = judged(whitening.whiten_embeddings(clashing), good)
    same_up_to_sign(again, want)
    assert whitening.whiten_embeddings(clashing).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_nothing_to_whiten(rows):
    for data in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5):
        out = whitening.whiten_embeddings(rows(data, SCHEMA))
        assert out.count() == 0 and dict(out.dtypes)["deviation"] == "bigint"


def test_repeated_rows_and_null_identifiers(rows):
    vectors = random_rows(20, 3)
    data = [(i % 4 if i % 5 else None, v) for i, v in enumerate(vectors + vectors[:7])]
    out = whitening.whiten_embeddings(rows(data, SCHEMA)).toPandas()
    assert len(out) == 27 * 3 and out["vec_id"].isna().sum() == 3 * sum(i is None for i, _ in data)
    assert set(out["n"]) == {27}


def test_large_numbers_stay_exact():
    centre = whitening.Centre(3, np.array([2**40], np.int64), np.array([1], np.int64))
    assert centre.deviation(np.array([[2**40 + 2**29], [0]], np.int64)) == [(3 * 2**29 - 1) ** 2, None]
    assert centre.centred(np.array([[2**40 + 5]], np.int64))[0, 0] == 5 - 1 / 3


def test_bidiagonal_form():
    r = np.random.default_rng(3)
    x = r.standard_normal((90, 7)) @ np.diag([9, 9, 4, 4, 1, 1e-3, 0])

    def product(left, q):
        p = x @ q
        return (x @ left).T @ p, x.T @ p, float(p @ p)

    right, band = whitening.bidiagonalise(product, 7, np.linalg.norm(x))
    assert np.allclose(right.T @ right, np.eye(7), atol=1e-12)
    assert np.allclose(np.tril(band, -1), 0) and np.allclose(np.triu(band, 2), 0)
    assert np.allclose(np.linalg.svd(band)[1], np.linalg.svd(x)[1], atol=1e-10)
